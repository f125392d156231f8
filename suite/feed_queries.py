"""Feeds and stored tables: streams merged once, bucketed tables, replaced dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from paddock import schema
from paddock.plans import ingest
from paddock.plans.starts import asof_starts
from paddock.schema import RacingTables
from paddock.session import scratch_path
from paddock.sources import tables
from paddock.streaming.files import ingest_stream
from suite.feature_queries import RR, STARTS
from suite.fixtures import AS_OF, given, racing, text_of
from suite.ingest_queries import EARLY, stored
from suite.registry import query


@query(
    "ingest_stream",
    f"""WITH n AS (SELECT COUNT(*) AS total, CAST(SUM(CASE WHEN {EARLY} THEN 1 ELSE 0 END) AS BIGINT) AS early FROM customer)
        SELECT c_custkey AS jockey_id, c_name AS first_name, c_mktsegment AS last_name, {EARLY} AS first_batch,
               {EARLY} AS touched_since, total AS staged, early AS updated, total - early AS inserted, CAST(0 AS BIGINT) AS staged_again
        FROM customer, n""",
)
def _(spark, sf):
    """Two batches of a stream, of which the second is handed over once more: the
    counts are those of the second batch and of its repetition."""
    landing, lake, folder = scratch_path(spark, "landing"), scratch_path(spark, "lake"), "jockey_data/"
    state = scratch_path(spark, "checkpoint")
    people = given(spark, sf, "customer")
    person = people.select(
        F.col("c_custkey").alias("jockey_id"), F.col("c_name").alias("first_name"), F.col("c_mktsegment").alias("last_name"), "c_nationkey"
    )
    early = person.where(EARLY).drop("c_nationkey")
    early.write.json(f"{landing}/{folder}CLEANED_1.ndjson")
    first = ingest_stream(spark, landing, lake, folder, state)
    person.drop("c_nationkey").write.json(f"{landing}/{folder}CLEANED_2.ndjson")
    second = ingest_stream(spark, landing, lake, folder, state)
    again = ingest.merge_batch(spark, lake, folder, person.drop("c_nationkey"), len(first) + len(second) - 1)
    out = tables.base_table(spark, lake, "jockeys").read()
    began = F.col("created_date") == F.lit(out.agg(F.min("created_date")).first()[0])
    counts = {**second[0]["jockeys"], "staged_again": again["jockeys"]["staged"]}
    return out.select(
        "jockey_id", "first_name", "last_name", began.alias("first_batch"), (F.col("last_updated_date") > F.col("created_date")).alias("touched_since"),
        *[F.lit(n).cast("long").alias(name) for name, n in counts.items()],
    )


@query(
    "bucketed_starts",
    f"""WITH {STARTS} SELECT race_id, horse_id, jockey_id, trainer_id, finish_place,
        CAST(day AS VARCHAR) AS race_date, track_type, track_distance_m FROM starts""",
    RR,
)
def _(spark, sf):
    """Starts of stored tables in buckets, half of the races merged in later."""
    t, lake = racing(spark, sf), scratch_path(spark, "lake")
    spark.conf.set("paddock.buckets", "8")
    try:
        for name in ("races", "race_records"):
            rows, table = stored(getattr(t, name), schema.BASE_TABLES[name]), tables.base_table(spark, lake, name)
            table.write(rows.where("race_id % 2 = 0"))
            # Starters have no key here that tells all of them apart.
            keyed = tables.MergedTable(spark, table.root, table.schema, ["race_record_id", "race_id", "horse_id", "start_order"], table.buckets)
            (keyed if name == "race_records" else table).merge(rows.where("race_id % 2 = 1"), F.current_timestamp())
    finally:
        spark.conf.unset("paddock.buckets")
    starts = asof_starts(RacingTables.load(spark, lake, touched=False), AS_OF)
    return text_of(starts.withColumn("race_date", F.to_date("race_date")), "race_date")


@query(
    "replace_date",
    """WITH days AS (SELECT event_type AS prefix, CAST(ts AS DATE) AS dt, ts FROM events),
            last AS (SELECT MAX(dt) AS dt FROM days)
        SELECT CAST(days.dt AS VARCHAR) AS dt, CASE WHEN days.dt = last.dt THEN 'new' ELSE prefix END AS prefix, COUNT(*) AS n
        FROM days, last GROUP BY ALL""",
)
def _(spark, sf):
    """Partitions by date, of which the last is replaced."""
    path, shape = scratch_path(spark, "by-date"), schema.INGESTION_METADATA
    rows = given(spark, sf, "events").select(F.col("event_type").alias("prefix"), F.col("ts").cast("timestamp").alias("last_processed_time"))
    tables.write_by_date(rows, path, "last_processed_time")
    day = F.to_date("last_processed_time")
    last = tables.read_by_date(spark, path, shape).agg(F.max("dt")).first()[0]
    tables.write_by_date(rows.where(day == F.lit(last)).withColumn("prefix", F.lit("new")), path, "last_processed_time", mode="replace")
    return tables.read_by_date(spark, path, shape).groupBy(F.col("dt").cast("string").alias("dt"), "prefix").agg(F.count(F.lit(1)).alias("n"))
