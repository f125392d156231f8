"""Staged documents -> base tables: projections, keys and the run itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from paddock import schema
from paddock.functions import farm
from paddock.functions import scalars as S
from paddock.operators.merge import merge_touch_or_insert
from paddock.plans.day_counters import DayCounters, touched_days
from paddock.schema import KEYS
from paddock.sources import files, ndjson
from paddock.sources.tables import VersionedTable, base_table

def staged_horses(staged: DataFrame) -> DataFrame:
    return staged.drop("career", "races")


def staged_careers(staged: DataFrame) -> DataFrame:
    """One row per (horse, season). Amounts become text, as the table holds them."""
    flat = staged.select("horse_id", F.inline("career"))
    return flat.withColumn("prize_amounts", F.col("prize_amounts").cast("string"))


def staged_races(staged: DataFrame) -> DataFrame:
    """Distinct races over all starters of the batch."""
    r = F.col("r")
    plain = """race_number race_name track_distance_m temperature_c weather race_group subtype
        category_id category_breed category_name country_code city_name track_type video_url
        race_rules payments race_style""".split()
    return (
        staged.select(F.explode("races").alias("r"))
        .select(
            r["race_id"].alias("race_id"),
            F.timestamp_millis(r["race_date"]).alias("race_date"),
            r["prize_currency"].alias("currency_code"),
            F.lit(None).cast("string").alias("currency_symbol"),
            F.lit(None).cast("long").alias("duration_ms"),
            *[r[c].alias(c) for c in plain],
        )
        .distinct()
    )


def staged_records(staged: DataFrame) -> DataFrame:
    """One row per starter with its surrogate key.

    Prize money is rounded to whole units, halves away from zero; a place that
    is not a number is NULL.
    """
    farm.register(staged.sparkSession)  # a stream's batches have a session of their own
    horse, r = F.col("horse_id"), F.col("r")
    return staged.select("horse_id", F.explode("races").alias("r")).select(
        S.record_key(horse, r["race_id"], r["start_order"]).alias("race_record_id"),
        r["race_id"].alias("race_id"),
        "horse_id",
        r["start_order"].alias("start_order"),
        r["finish_place"].try_cast("long").alias("finish_place"),
        r["jockey_weight_kg"].alias("jockey_weight_kg"),
        F.round(r["prize_amount"].try_cast("double")).alias("prize_amount"),
        r["prize_currency"].alias("prize_currency"),
        r["jockey_id"].alias("jockey_id"),
        r["trainer_id"].alias("trainer_id"),
    )


HORSE_TARGETS = {
    "horses": staged_horses,
    "horse_careers": staged_careers,
    "races": staged_races,
    "race_records": staged_records,
}


def upsert(target: DataFrame, staged: DataFrame, table: str, now: Column, update=()) -> DataFrame:
    """Merge a staged projection into a base table on the table's key."""
    return merge_touch_or_insert(target, staged, KEYS[table], now, update)


def advance_watermark(meta: DataFrame, seen: DataFrame) -> DataFrame:
    """Per prefix the newest creation time seen so far.

    ``seen`` has ``prefix, created``. The watermark never moves back.
    """
    newest = seen.select("prefix", F.col("created").alias("last_processed_time"))
    both = meta.unionByName(newest)
    return both.groupBy("prefix").agg(F.max("last_processed_time").alias("last_processed_time"))


# What each folder of cleaned files feeds, how it is staged, and how many
# malformed rows its load tolerates.
FEEDS = {
    "horse_data/": (schema.STAGED_HORSE, HORSE_TARGETS, 5),
    "jockey_data/": (schema.STAGED_JOCKEY, {"jockeys": lambda df: df}, 0),
    "trainer_data/": (schema.STAGED_TRAINER, {"trainers": lambda df: df}, 0),
    "breeder_data/": (schema.STAGED_BREEDER, {"breeders": lambda df: df}, 0),
}


def new_units(spark: SparkSession, folder: str, done: DataFrame, after: str = "", page: int = files.PAGE) -> list:
    """The first ``page`` cleaned inputs of a folder that ``done`` does not name, in the
    order of their names from ``after`` on: ``unit, created, parts``.

    A unit is a file, or a directory of part files (``parts``). Units are told by name,
    not by time, so one that is committed late is not missed.
    """
    listing = files.discover_new_files(spark, folder)
    unit = F.regexp_replace("path", r"/part-[^/]*$", "").alias("unit")
    parts = F.bool_or(F.col("path").rlike(r"/part-[^/]*$")).alias("parts")
    units = listing.groupBy(unit).agg(parts, F.max("created").alias("created"))
    return units.where(F.col("unit") > after).join(done.select("unit"), "unit", "left_anti").orderBy("unit").limit(page).collect()


def ingest_folder(spark: SparkSession, landing: str, lake: str, prefix: str, counters: DayCounters = None, page: int = files.PAGE) -> dict:
    """Ingest the new cleaned files under one prefix; returns the merge counts. With
    ``counters`` the days that new starts fall on are counted again.

    New files are loaded in batches of at most ``page``. What was ingested is noted, and
    the watermark moved, only after every table is written, so a failed run is simply
    repeated. A directory that is still being written waits for a later run.
    """
    if prefix not in FEEDS:
        raise ValueError(f"unknown prefix {prefix!r}; expected one of {sorted(FEEDS)}")
    ingested = VersionedTable(spark, f"{lake}/ingested_units/{prefix.rstrip('/')}", schema.INGESTED_UNITS)
    result, after = {"processed_files": 0}, ""
    while units := new_units(spark, f"{landing}/{prefix}", ingested.read(), after, page):
        after = units[-1].unit
        found = [u for u in units if not u.parts or files.committed(spark, u.unit)]
        if found:
            counts = _ingest_units(spark, lake, prefix, found, ingested, counters)
            result["processed_files"] += len(found)
            for name, count in counts.items():
                result[name] = {k: n + result.get(name, {}).get(k, 0) for k, n in count.items()}
    return result


def _ingest_units(spark: SparkSession, lake: str, prefix: str, found: list, ingested: VersionedTable, counters: DayCounters | None) -> dict:
    staged_schema, targets, budget = FEEDS[prefix]
    # Staged once in columns: each target then reads only its own part.
    staged = ndjson.load_with_bad_budget(spark, [u.unit for u in found], staged_schema, budget)
    counts = {name: base_table(spark, lake, name).merge(project(staged), F.current_timestamp()) for name, project in targets.items()}
    if counters is not None and "race_records" in targets:
        tables = schema.RacingTables.load(spark, lake)
        counters.extend(tables, touched_days(tables.races, staged_records(staged)))
    meta = VersionedTable(spark, f"{lake}/ingestion_metadata", schema.INGESTION_METADATA)
    marks = spark.createDataFrame([(prefix, max(u.created for u in found))], "prefix string, created timestamp")
    meta.write(advance_watermark(meta.read(), marks))
    noted = spark.createDataFrame([(u.unit, u.created) for u in found], schema.INGESTED_UNITS)
    ingested.write(ingested.read().unionByName(noted))
    ingested.expire(keep=2)
    return counts


def merge_batch(spark: SparkSession, lake: str, prefix: str, staged: DataFrame, batch: int, counters: DayCounters = None) -> dict:
    """Merge one numbered batch of a stream into the tables its prefix feeds; returns
    the merge counts. A batch that comes again, whole or half done, changes nothing
    that is done already."""
    _, targets, _ = FEEDS[prefix]
    feed, result = prefix.rstrip("/"), {}
    for name, project in targets.items():
        result[name] = base_table(spark, lake, name).merge(project(staged), F.current_timestamp(), (feed, batch))
    if counters is not None and "race_records" in targets:
        tables = schema.RacingTables.load(spark, lake)
        counters.extend(tables, touched_days(tables.races, staged_records(staged)))
    return result


def clean_masters(spark: SparkSession, folder: str) -> dict:
    """Clean every finished master of a folder that is not cleaned yet; returns the
    sums of their statistics, nothing if there was none."""
    total = {}
    for name in files.masters_to_clean(spark, folder):
        for key, n in clean_folder(spark, f"{folder}/{name}", f"{folder}/CLEANED_{name}").items():
            total[key] = total.get(key, 0) + n
    return total


def clean_folder(spark: SparkSession, master: str, out: str) -> dict:
    """Clean one master directory into ``out``; does nothing when that is done.

    What a failed job left of ``out``, without the mark of a finished one, is
    written anew.

    Lines are parsed and shuffled once, and the job that writes the distinct
    records also counts them.
    """
    if files.committed(spark, out):
        return {}
    lines = ndjson.read_ndjson(spark, master)
    seen = Observation()
    counted = ndjson.record_counts(lines).observe(seen, *ndjson.stats_columns())
    counted.where(F.col(ndjson.RECORD).isNotNull()).select(ndjson.RECORD).write.mode("overwrite").text(out)
    return seen.get
