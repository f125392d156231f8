"""Sources, sinks, cleaning, normalization and merges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from paddock import flow, schema
from paddock.functions import scalars as S
from paddock.functions import vocab as V
from paddock.operators.merge import merge_counts, merge_touch_or_insert
from paddock.plans import ingest, normalize
from paddock.plans.names import inline_entries, resolve_names
from paddock.plans.races import field_size, races_base
from paddock.schema import RacingTables, with_schema
from paddock.session import scratch_path
from paddock.sources import files, ndjson, tables
from suite.feature_queries import CONTEXT, RACES_BASE
from suite.fixtures import given, over, racing, view
from suite.registry import dbl, query, rnd

# ---- NDJSON -----------------------------------------------------------------
EVENT_LINES = """
SELECT CASE WHEN event_type = 'error' THEN CONCAT('{"event_id": ', CAST(event_id AS VARCHAR(20)), ', "props": ', props)
            WHEN event_type = 'view' THEN CONCAT(props, ' ', CAST(event_id AS VARCHAR(20)))
            ELSE CONCAT('{"event_id": ', CAST(event_id AS VARCHAR(20)), ', "props": ', props, '}') END AS line
FROM events
"""


@query(
    "read_ndjson",
    """WITH lines AS (SELECT event_id, props, event_type NOT IN ('error', 'view') AS good FROM events)
       SELECT good AS well_formed, CASE WHEN good THEN event_id END AS event_id,
              CASE WHEN good THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM lines""",
)
def _(spark, sf):
    """Lines go through real files; unclosed lines and trailing text are bad."""
    path = scratch_path(spark, "ndjson")
    over(spark, sf, EVENT_LINES).write.text(path)
    record = F.col(ndjson.RECORD)
    return ndjson.read_ndjson(spark, path).select(
        record.isNotNull().alias("well_formed"),
        F.get_json_object(record, "$.event_id").cast("long").alias("event_id"),
        F.get_json_object(record, "$.props.k").cast("long").alias("k"),
    )


@query(
    "load_with_bad_budget",
    "SELECT c_custkey AS jockey_id, c_name AS first_name, c_mktsegment AS last_name FROM customer",
)
def _(spark, sf):
    """All customers as JSON plus one malformed line per region: five, the budget."""
    path = scratch_path(spark, "load")
    person = F.struct(
        F.col("c_custkey").alias("jockey_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
    )
    good = given(spark, sf, "customer").select(F.to_json(person).alias("value"))
    bad = given(spark, sf, "region").select(F.concat(F.lit('{"jockey_id": "'), "r_name").alias("value"))
    good.unionByName(bad).write.text(path)
    loaded = ndjson.load_with_bad_budget(spark, path, schema.STAGED_JOCKEY, max_bad=5)
    return loaded.select("jockey_id", "first_name", "last_name")


def document_lines(spark, sf):
    """Every document as a JSON line, and once more with its end cut off."""
    whole = given(spark, sf, "documents").select(F.to_json(F.struct("text", "lang")).alias("line"))
    cut = whole.select(F.substring("line", F.lit(1), F.length("line") - 1).alias("line"))
    lines = whole.unionByName(cut)
    return lines.withColumn(ndjson.RECORD, ndjson.parse_line(F.col("line")))


@query("clean_dedupe", "SELECT DISTINCT lang, md5(text) AS digest, length(text) AS n_chars FROM documents")
def _(spark, sf):
    records = ndjson.clean_dedupe(document_lines(spark, sf))
    text = F.get_json_object(ndjson.RECORD, "$.text")
    return records.select(
        F.get_json_object(ndjson.RECORD, "$.lang").alias("lang"),
        F.md5(text.cast("binary")).alias("digest"),
        F.length(text).cast("long").alias("n_chars"),
    )


@query(
    "clean_stats",
    """WITH d AS (SELECT COUNT(*) AS n FROM documents),
            k AS (SELECT COUNT(*) AS n FROM (SELECT DISTINCT text, lang FROM documents))
       SELECT 2 * d.n AS initial_count, 2 * d.n - k.n AS removed_count, k.n AS final_count FROM d, k""",
)
def _(spark, sf):
    return ndjson.clean_stats(ndjson.record_counts(document_lines(spark, sf)))


# ---- files ------------------------------------------------------------------
LISTING = """
SELECT CONCAT('horse_data/', CASE WHEN url LIKE 'https:%' THEN 'CLEANED_' ELSE '' END,
              CASE WHEN page_id % 5 = 0 THEN 'MASTERFILE_HORSEDATA_20250803T1015_' ELSE 'MASTERFILE_JOCKEY_2025-08-03T10_15_' END,
              CAST(page_id AS VARCHAR(20)), CASE WHEN url LIKE '%?%' THEN 'Z.ndjson' ELSE 'Z.json' END) AS path,
       CAST(TIMESTAMP '2025-01-01 00:00:00' AS TIMESTAMP) + INTERVAL '1' HOUR * CAST(page_id AS INTEGER) AS created,
       page_id AS length
FROM pages
"""


@query(
    "discover_new_files",
    f"""WITH listing AS ({LISTING}) SELECT path, epoch_us(created) AS created_us FROM listing
        WHERE path LIKE '%CLEANED\\_%' ESCAPE '\\' AND path LIKE '%.ndjson'
          AND created > TIMESTAMP '2025-01-03 00:00:00'""",
)
def _(spark, sf):
    new = files.select_new_files(over(spark, sf, LISTING), dt.datetime(2025, 1, 3))
    return new.select("path", F.unix_micros(F.col("created").cast("timestamp")).alias("created_us"))


@query(
    "file_tag",
    f"""WITH listing AS ({LISTING}) SELECT path, CASE
            WHEN path LIKE '%CLEANED\\_MASTERFILE\\_%.ndjson' ESCAPE '\\'
                THEN string_split(regexp_extract(path, '([^/]+)\\.ndjson', 1), 'MASTERFILE_')[2][
                    strpos(string_split(path, 'MASTERFILE_')[2], '_') + 1 : ]
            ELSE strftime(created, '%Y-%m-%dT%H_%M_%S_') || '000Z' END AS tag FROM listing""",
)
def _(spark, sf):
    return files.file_tags(over(spark, sf, LISTING)).select("path", "tag")


@query("merge_shards", "SELECT doc_id, source, md5(text) AS digest FROM documents")
def _(spark, sf):
    """One shard directory per source, merged into one master directory."""
    shards, master = scratch_path(spark, "shards"), scratch_path(spark, "master")
    line = F.to_json(F.struct("doc_id", "source", F.md5(F.col("text").cast("binary")).alias("digest")))
    docs = given(spark, sf, "documents")
    docs.select(line.alias("value"), F.col("source").alias("shard")).write.partitionBy("shard").text(shards)
    files.merge_shards(spark, shards, master, pattern=r"^shard=.+$")
    row = F.from_json("value", "doc_id bigint, source string, digest string").alias("r")
    return spark.read.text(master).select(row).select("r.*")


UPCOMING_COLUMNS = [f.name for f in schema.UPCOMING.fields]


@query(
    "read_upcoming_csv",
    f"""WITH st AS ({RACES_BASE}), cx AS ({CONTEXT})
        SELECT r.race_number, c.horse_id, q.trainer_id, q.jockey_id, c.jockey_weight_kg, c.field_size, c.start_order,
               s.* EXCLUDE (race_id, style_ease_score, breed_thoroughbred, breed_arabian, breed_standardbred,
                            breed_anglo_arabian),
               s.breed_thoroughbred AS race_breed_thoroughbred, s.breed_arabian AS race_breed_arabian,
               s.breed_standardbred AS race_breed_standardbred, s.breed_anglo_arabian AS race_breed_anglo_arabian
        FROM cx c JOIN race_records q ON q.race_id = c.race_id AND q.horse_id = c.horse_id
            AND q.race_record_id = c.race_record_id
        JOIN st s ON s.race_id = c.race_id JOIN races r ON r.race_id = c.race_id""",
    "races race_records",
)
def _(spark, sf):
    t, path = racing(spark, sf), scratch_path(spark, "upcoming")
    static = races_base(t).withColumnsRenamed({c: f"race_{c}" for c in V.BREEDS.values()})
    race = static.join(t.races.select("race_id", "race_number"), "race_id").join(field_size(t), "race_id")
    rows = t.race_records.join(race, "race_id").select(*UPCOMING_COLUMNS)
    rows.write.option("header", "true").csv(path)
    return files.read_upcoming_csv(spark, path)


# ---- sinks ------------------------------------------------------------------
HISTORY = """
SELECT o_orderpriority AS model_name, TIMESTAMP '2001-06-30 10:00:00' AS eval_timestamp,
       AVG(o_totalprice / 1000) AS mean_absolute_error, MAX(o_totalprice) AS r2_score
FROM orders GROUP BY o_orderpriority
"""


@query(
    "append_history",
    f"""WITH h AS ({HISTORY})
        SELECT model_name, epoch_us(eval_timestamp) AS at_us, {rnd("mean_absolute_error", "mean_absolute_error")},
               CAST(NULL AS DOUBLE) AS mean_squared_error, r2_score FROM h
        UNION ALL
        SELECT CONCAT(model_name, ' again'), epoch_us(eval_timestamp), {rnd("mean_absolute_error", "m")},
               CAST(NULL AS DOUBLE), r2_score FROM h""",
    rounds="mean_absolute_error",
)
def _(spark, sf):
    path, shape = scratch_path(spark, "history"), schema.MODEL_EVAL_HISTORY
    rows = over(spark, sf, HISTORY)
    tables.append_history(rows, path, shape)
    again = rows.withColumn("model_name", F.concat("model_name", F.lit(" again")))
    tables.append_history(again, path, shape)
    at = F.unix_micros(F.col("eval_timestamp").cast("timestamp")).alias("at_us")
    return tables.read_history(spark, path, shape).select(
        "model_name", at, "mean_absolute_error", "mean_squared_error", "r2_score"
    )


@query(
    "partitioned_write",
    """SELECT event_type AS prefix, CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, COUNT(*) AS n,
              MAX(epoch_us(ts)) AS last_us FROM events GROUP BY 1, 2""",
)
def _(spark, sf):
    path, shape = scratch_path(spark, "by-date"), schema.INGESTION_METADATA
    rows = given(spark, sf, "events").select(
        F.col("event_type").alias("prefix"), F.col("ts").cast("timestamp").alias("last_processed_time")
    )
    tables.write_by_date(rows, path, "last_processed_time")
    back = tables.read_by_date(spark, path, shape)
    return back.groupBy("prefix", F.col("dt").cast("string").alias("dt")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.unix_micros("last_processed_time")).alias("last_us")
    )


# ---- merges -----------------------------------------------------------------
# The batch holds every row of the table again under a doubled key: even keys
# of the table are touched, keys beyond its end are inserted.
OLD, NOW = "2001-01-01 00:00:00", "2001-06-30 12:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


def stored(df, shape):
    """A base table as it was left by an earlier run."""
    old = F.lit(OLD).cast("timestamp")
    return with_schema(df.withColumns({"created_date": old, "last_updated_date": old}), shape)


def merged(base, name, staged):
    """The table after one merge, as large as itself, into its stored form."""
    table = tables.base_table(base.sparkSession, scratch_path(base.sparkSession, "lake"), name)
    table.write(base)
    table.merge(staged, now(), whole=True)
    return table.read()


def stamped(df, *columns):
    return df.select(*columns, *[F.col(c).cast("string").alias(c) for c in ("created_date", "last_updated_date")])


def merged_sql(table: str, key: str, columns: str, keys: str = None, source: str = None) -> str:
    """Outcome of the doubled-key merge; ``columns`` are plain columns."""
    keys = keys or key
    match = " AND ".join(f"s.{k} IS NOT DISTINCT FROM t.{k}" for k in keys.split(", "))
    source = source or f"SELECT * REPLACE ({key} * 2 AS {key}) FROM {table}"
    return f"""WITH src AS ({source})
        SELECT {columns}, '{OLD}' AS created_date,
               CASE WHEN EXISTS (SELECT 1 FROM src s WHERE {match}) THEN '{NOW}' ELSE '{OLD}' END AS last_updated_date
        FROM {table} t
        UNION ALL
        SELECT {columns}, '{NOW}', '{NOW}' FROM src s
        WHERE NOT EXISTS (SELECT 1 FROM {table} t WHERE {match})"""


HORSE_COLUMNS = "horse_id, horse_name, birth_year, horse_sex, father_id, breeder_id, color_name_pl"


@query("upsert_horses", merged_sql("horses", "horse_id", HORSE_COLUMNS), "horses")
def _(spark, sf):
    base = view(spark, sf, "horses")
    batch = with_schema(base.withColumn("horse_id", F.col("horse_id") * 2), schema.STAGED_HORSE)
    out = merged(stored(base, schema.HORSES), "horses", ingest.staged_horses(batch))
    return stamped(out, *HORSE_COLUMNS.split(", "))


@query(
    "upsert_careers",
    merged_sql(
        "horse_careers",
        "horse_id",
        "horse_id, race_year, race_type, race_count, race_won_count, TRY_CAST(prize_amounts AS DOUBLE) AS prize_amounts",
        "horse_id, race_year, race_type",
    ),
    "horse_careers",
)
def _(spark, sf):
    base = view(spark, sf, "horse_careers")
    season = F.struct(
        "race_year",
        "race_type",
        F.lit(None).cast("long").alias("horse_age"),
        "race_count",
        "race_won_count",
        F.lit(None).cast("long").alias("race_prize_count"),
        F.col("prize_amounts").try_cast("double").alias("prize_amounts"),
        F.lit("PLN").alias("prize_currencies"),
    )
    batch = base.select((F.col("horse_id") * 2).alias("horse_id"), F.array(season).alias("career"))
    staged = ingest.staged_careers(with_schema(batch, schema.STAGED_HORSE))
    out = merged(stored(base, schema.HORSE_CAREERS), "horse_careers", staged)
    amount = F.col("prize_amounts").try_cast("double").alias("prize_amounts")
    return stamped(out, "horse_id", "race_year", "race_type", "race_count", "race_won_count", amount)


def race_docs(rows, **changes):
    """One staged document per row, whose only race entry is that row."""
    have = set(rows.columns)
    entry = [
        changes.get(f.name, F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.STAGED_RACE.fields
    ]
    horse = F.col("horse_id") if "horse_id" in have else F.lit(None).cast("long")
    return with_schema(
        rows.select(horse.alias("horse_id"), F.array(F.struct(*entry)).alias("races")), schema.STAGED_HORSE
    )


RACE_COLUMNS = """race_id, race_number, epoch_ms(race_date) AS race_ms, track_distance_m, temperature_c, weather,
    race_group, category_id, country_code, track_type, payments, race_style"""


@query("upsert_races", merged_sql("races", "race_id", RACE_COLUMNS), "races")
def _(spark, sf):
    base = view(spark, sf, "races")
    at = F.unix_millis(F.col("race_date").cast("timestamp"))
    docs = race_docs(base, race_id=F.col("race_id") * 2, race_date=at)
    out = merged(stored(base, schema.RACES), "races", ingest.staged_races(docs))
    ms = F.unix_millis("race_date").alias("race_ms")
    plain = [c.strip() for c in RACE_COLUMNS.split(",") if "epoch" not in c]
    return stamped(out, ms, *plain)


TEXT_KEY = """CONCAT(CAST(horse_id AS VARCHAR), '_', CAST(race_id AS VARCHAR), '_',
    COALESCE(CAST(start_order AS VARCHAR), ''))"""
MOVED = "CASE WHEN finish_place >= 4 THEN start_order ELSE start_order + 100 END"


@query(
    "upsert_records",
    f"""WITH old AS (SELECT {TEXT_KEY} AS record, start_order, finish_place, jockey_weight_kg, prize_amount, jockey_id
                     FROM race_records),
        batch AS (SELECT * REPLACE ({MOVED} AS start_order, ROUND(prize_amount) AS prize_amount) FROM race_records),
        src AS (SELECT * FROM (SELECT {TEXT_KEY} AS record, start_order, finish_place, jockey_weight_kg, prize_amount,
                    jockey_id, ROW_NUMBER() OVER (PARTITION BY {TEXT_KEY} ORDER BY finish_place NULLS FIRST,
                    jockey_weight_kg NULLS FIRST, prize_amount NULLS FIRST, jockey_id, trainer_id) AS rn FROM batch)
                WHERE rn = 1)
        SELECT record, start_order, finish_place, jockey_weight_kg, prize_amount, jockey_id, '{OLD}' AS created_date,
               CASE WHEN record IN (SELECT record FROM src) THEN '{NOW}' ELSE '{OLD}' END AS last_updated_date FROM old
        UNION ALL
        SELECT record, start_order, finish_place, jockey_weight_kg, prize_amount, jockey_id, '{NOW}', '{NOW}'
        FROM src WHERE record NOT IN (SELECT record FROM old)""",
    "race_records",
)
def _(spark, sf):
    base = view(spark, sf, "race_records")
    key = S.record_key(F.col("horse_id"), F.col("race_id"), F.col("start_order"))
    order = F.when(F.col("finish_place") >= 4, F.col("start_order")).otherwise(F.col("start_order") + 100)
    staged = ingest.staged_records(race_docs(base, start_order=order))
    target = stored(base.withColumn("race_record_id", key), schema.RACE_RECORDS)
    out = merged(target, "race_records", staged)
    text = S.record_text(F.col("horse_id"), F.col("race_id"), F.col("start_order")).alias("record")
    return stamped(out, text, "start_order", "finish_place", "jockey_weight_kg", "prize_amount", "jockey_id")


PEOPLE = {
    "jockeys": ("jockey_id", "first_name", "last_name"),
    "trainers": ("trainer_id", "first_name", "last_name"),
    "breeders": ("breeder_id", "name", "city"),
}


@query(
    "upsert_reference",
    " UNION ALL ".join(
        f"SELECT * FROM ({merged_sql(n, k, f'{chr(39)}{n}{chr(39)} AS kind, {k} AS id, {a} AS first_text, {b} AS second_text', k)})"
        for n, (k, a, b) in PEOPLE.items()
    ),
    "jockeys trainers breeders",
)
def _(spark, sf):
    out = None
    for name, (key, first, second) in PEOPLE.items():
        base = view(spark, sf, name)
        batch = base.withColumn(key, F.col(key) * 2)
        done = merged(stored(base, schema.BASE_TABLES[name]), name, batch)
        part = stamped(
            done,
            F.lit(name).alias("kind"),
            F.col(key).alias("id"),
            F.col(first).alias("first_text"),
            F.col(second).alias("second_text"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "merge_counts",
    """WITH s AS (SELECT DISTINCT c_custkey * 2 AS id FROM customer), t AS (SELECT DISTINCT c_custkey AS id FROM customer)
       SELECT COUNT(*) AS staged, COUNT(t.id) AS updated, COUNT(*) - COUNT(t.id) AS inserted
       FROM s LEFT JOIN t ON t.id = s.id""",
)
def _(spark, sf):
    base = given(spark, sf, "customer").select("c_custkey")
    return merge_counts(base, base.select((F.col("c_custkey") * 2).alias("c_custkey")), ["c_custkey"])


# NULL segments are part of the key; a match also overwrites the balance.
ACCOUNTS = """
SELECT c_custkey AS id, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS segment,
       c_acctbal AS balance FROM customer
"""


@query(
    "merge_touch_or_insert",
    f"""WITH t AS ({ACCOUNTS}), s AS (SELECT id * 2 AS id, segment, balance + 1 AS balance FROM t)
        SELECT t.id, t.segment, ROUND(CASE WHEN s.id IS NULL THEN t.balance ELSE s.balance END, 2) AS balance,
               '{OLD}' AS created_date, CASE WHEN s.id IS NULL THEN '{OLD}' ELSE '{NOW}' END AS last_updated_date
        FROM t LEFT JOIN s ON s.id = t.id AND s.segment IS NOT DISTINCT FROM t.segment
        UNION ALL
        SELECT s.id, s.segment, ROUND(s.balance, 2), '{NOW}', '{NOW}' FROM s
        WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.id = s.id AND t.segment IS NOT DISTINCT FROM s.segment)""",
)
def _(spark, sf):
    base = over(spark, sf, ACCOUNTS)
    old = F.lit(OLD).cast("timestamp")
    target = base.withColumns({"created_date": old, "last_updated_date": old})
    batch = base.select((F.col("id") * 2).alias("id"), "segment", (F.col("balance") + 1).alias("balance"))
    out = merge_touch_or_insert(target, batch, ["id", "segment"], now(), update=["balance"])
    return stamped(out, "id", "segment", F.round("balance", 2).alias("balance"))


@query(
    "watermark_upsert",
    "SELECT CONCAT(event_type, '/') AS prefix, MAX(epoch_us(ts)) AS last_us FROM events GROUP BY event_type",
)
def _(spark, sf):
    events = given(spark, sf, "events")
    seen = events.select(F.concat("event_type", F.lit("/")).alias("prefix"), F.col("ts").cast("timestamp").alias("created"))
    meta = seen.groupBy("prefix").agg(F.min("created").alias("last_processed_time"))
    out = ingest.advance_watermark(meta, seen)
    return out.select("prefix", F.unix_micros("last_processed_time").alias("last_us"))


# Two rounds of one feed: the customers of the first nations, then all of them,
# the second time with malformed lines between.
EARLY = "c_nationkey < 13"


@query(
    "ingest_feed",
    f"""WITH n AS (SELECT COUNT(*) AS total, CAST(SUM(CASE WHEN {EARLY} THEN 1 ELSE 0 END) AS BIGINT) AS early FROM customer),
            r AS (SELECT COUNT(*) AS bad FROM region)
        SELECT c_custkey AS jockey_id, c_name AS first_name, c_mktsegment AS last_name, {EARLY} AS first_round,
               {EARLY} AS touched_since, CAST(1 AS BIGINT) AS merged, total + bad AS initial_count, total AS final_count,
               total AS staged, early AS updated, total - early AS inserted
        FROM customer, n, r""",
)
def _(spark, sf):
    """Shards, master, cleaned file and merge, twice; the counts are the second round's."""
    landing, lake, folder = scratch_path(spark, "landing"), scratch_path(spark, "lake"), "jockey_data/"
    person = F.struct(
        F.col("c_custkey").alias("jockey_id"), F.col("c_name").alias("first_name"), F.col("c_mktsegment").alias("last_name")
    )
    people = given(spark, sf, "customer")
    line = F.to_json(person).alias("value")
    bad = given(spark, sf, "region").select(F.concat(F.lit('{"jockey_id": "'), "r_name").alias("value"))
    people.where(EARLY).select(line).write.text(f"{landing}/{folder}shard_1.ndjson")
    first = flow.run_feed(spark, landing, lake, folder, "2025-08-03T10_00_00_000Z")
    people.select(line).unionByName(bad).write.text(f"{landing}/{folder}shard_2.ndjson")
    second = flow.run_feed(spark, landing, lake, folder, "2025-08-04T10_00_00_000Z")
    counts = {"merged": second["merged"], **{k: second["clean"].get(k) for k in ("initial_count", "final_count")}}
    counts.update(second["ingest"]["jockeys"])
    out = tables.base_table(spark, lake, "jockeys").read()
    early = F.col("created_date") == F.lit(out.agg(F.min("created_date")).first()[0])
    assert first["ingest"]["jockeys"]["inserted"] == counts["updated"]
    return out.select(
        "jockey_id",
        "first_name",
        "last_name",
        early.alias("first_round"),
        (F.col("last_updated_date") > F.col("created_date")).alias("touched_since"),
        *[F.lit(n).cast("long").alias(name) for name, n in counts.items()],
    )


# ---- normalization ----------------------------------------------------------
# Raw career entries: purchases open a season, other events carry a prize text.
CAREER_ROWS = """
SELECT user_id AS horse_id, event_id AS pos, ts,
       CASE WHEN event_type = 'purchase' THEN CAST(2000 + event_id % 4 AS BIGINT) END AS raceYear,
       CASE WHEN event_type <> 'purchase' THEN NULL WHEN event_id % 3 = 0 THEN 'Sulki' WHEN event_id % 3 = 1 THEN '' END AS raceType,
       CAST(event_id % 6 AS BIGINT) AS horseAge,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id % 9 AS BIGINT) END AS raceCount,
       CAST(event_id % 2 AS BIGINT) AS raceWonCount, CAST(event_id % 4 AS BIGINT) AS racePrizeCount,
       CASE WHEN event_id % 11 = 0 THEN CONCAT(CAST(event_id % 90 AS VARCHAR(20)), ' 800 PLN')
            WHEN event_id % 13 = 0 THEN 'x EUR' WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN ''
            ELSE CONCAT(' ', REPLACE(CAST(value AS VARCHAR(20)), '.', ','), ' ',
                 CASE event_id % 7 WHEN 0 THEN 'PLN' WHEN 1 THEN 'EUR' WHEN 2 THEN 'Kč' WHEN 3 THEN 'zł'
                      WHEN 4 THEN '$' WHEN 5 THEN 'USDX' ELSE '' END) END AS prize
FROM events
"""
FX_SQL = "CASE {c} " + " ".join(
    f"WHEN '{k}' THEN {v}" for k, v in {k.lower(): v for k, v in V.FX_TO_PLN.items()}.items()
) + " ELSE 1.0 END"
AMOUNT_SQL = "COALESCE(TRY_CAST(REPLACE(split_part(trim(prize), ' ', 1), ',', '.') AS DOUBLE), 0)"
CURRENCY_SQL = "LOWER(COALESCE(NULLIF(split_part(trim(prize), ' ', 2), ''), 'pln'))"
PLN_SQL = f"""CASE WHEN prize IS NULL OR prize = '' THEN 0
    ELSE {AMOUNT_SQL} * CAST({FX_SQL.format(c=CURRENCY_SQL)} AS DOUBLE) END"""


@query(
    "parse_prize",
    f"""WITH c AS ({CAREER_ROWS}) SELECT pos, {dbl(AMOUNT_SQL, 'amount')}, {CURRENCY_SQL} AS currency
        FROM c WHERE prize <> ''""",
)
def _(spark, sf):
    text = F.col("prize")
    return over(spark, sf, CAREER_ROWS).where(text != "").select(
        "pos", S.prize_value(text).alias("amount"), S.prize_currency(text).alias("currency")
    )


@query("fx_to_pln", f"WITH c AS ({CAREER_ROWS}) SELECT pos, {dbl(PLN_SQL, 'pln')} FROM c")
def _(spark, sf):
    return over(spark, sf, CAREER_ROWS).select("pos", S.prize_in_pln(F.col("prize")).alias("pln"))


@query(
    "normalize_career",
    f"""WITH c AS ({CAREER_ROWS}),
        placed AS (SELECT *, MAX(CASE WHEN raceYear IS NOT NULL THEN pos END) OVER (PARTITION BY horse_id ORDER BY ts, pos
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS opener FROM c),
        keyed AS (SELECT p.*, o.raceYear AS y, COALESCE(NULLIF(o.raceType, ''), 'UNKNOWN') AS kind
            FROM placed p JOIN c o ON o.pos = p.opener),
        firsts AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY horse_id, y, kind ORDER BY ts, pos) AS rn
            FROM keyed WHERE raceYear IS NOT NULL) WHERE rn = 1),
        won AS (SELECT horse_id, y, kind, SUM(CASE WHEN raceYear IS NULL THEN {PLN_SQL} ELSE 0 END) AS pln
            FROM keyed GROUP BY horse_id, y, kind)
        SELECT f.horse_id, f.y AS race_year, NULLIF(f.raceType, '') AS race_type, NULLIF(f.horseAge, 0) AS horse_age,
            COALESCE(f.raceCount, 0) AS race_count, f.raceWonCount AS race_won_count,
            f.racePrizeCount AS race_prize_count, {rnd("w.pln", "prize_amounts")}, 'PLN' AS prize_currencies
        FROM firsts f JOIN won w ON w.horse_id = f.horse_id AND w.y = f.y AND w.kind = f.kind""",
    rounds="prize_amounts",
)
def _(spark, sf):
    return normalize.normalize_career_rows(over(spark, sf, CAREER_ROWS), ["horse_id"], ["ts", "pos"])


# Raw documents: one per starter. Every field is zero or blank, absent, or filled.
RAW_NUMBERS = {
    "horse_id": "horse.id", "race_id": "race.id", "start_order": "order", "jockey_id": "jockey.id",
    "trainer_id": "trainer.id", "race_number": "race.number", "race_date": "race.date",
    "track_distance_m": "race.trackDistance", "category_id": "race.category.id",
}
RAW_DECIMALS = {"jockey_weight_kg": "jockeyWeight", "temperature_c": "race.temperature"}
RAW_TEXTS = {
    "prize_currency": "race.currency.code", "race_name": "race.name", "video_url": "race.video",
    "weather": "race.weather", "race_group": "race.group", "subtype": "race.subType",
    "category_breed": "race.category.horseBreed", "category_name": "race.category.name",
    "country_code": "race.country.alfa3", "city_name": "race.city.name", "track_type": "race.trackType.name",
    "race_rules": "race.fullConditions", "payments": "race.payments", "race_style": "race.style.name",
}


def raw_case(i: int, low: str, kind: str, filled: str) -> str:
    """SQL of the i-th raw field, each with a cycle of its own."""
    place = f"(l_orderkey + {i} * l_linenumber) % {3 + i % 5}"
    return f"CASE {place} WHEN 0 THEN {low} WHEN 1 THEN CAST(NULL AS {kind}) ELSE {filled} END"


RAW_COLUMNS = ", ".join(
    [f"{raw_case(i, '0', 'BIGINT', f'CAST(l_partkey + {i} AS BIGINT)')} AS {n}" for i, n in enumerate(RAW_NUMBERS)]
    + [f"{raw_case(i, '0e0', 'DOUBLE', f'l_quantity - 20.5e0 - {i}')} AS {n}" for i, n in enumerate(RAW_DECIMALS)]
    + [raw_case(i, "''", "VARCHAR(40)", f"CONCAT('{n} ', CAST(l_suppkey AS VARCHAR(20)))") + f" AS {n}" for i, n in enumerate(RAW_TEXTS)]
)
RAW_STARTS = f"""SELECT {RAW_COLUMNS}, CAST(l_linenumber - 2 AS DOUBLE) AS place, l_linenumber AS line,
    CAST(CAST(ROUND(l_extendedprice) AS BIGINT) AS VARCHAR(20)) AS price FROM lineitem"""
# JSON of the prize: numbers and texts, zero as both, blank and null.
RAW_PRIZE = """CASE line WHEN 1 THEN price WHEN 2 THEN CONCAT('"', price, ' PLN"') WHEN 3 THEN '0.0' WHEN 4 THEN '"0"'
    WHEN 5 THEN '""' WHEN 6 THEN 'null' ELSE '0' END"""


@query(
    "normalize_races",
    f"""WITH s AS ({RAW_STARTS}) SELECT {", ".join(f"NULLIF({n}, 0) AS {n}" for n in [*RAW_NUMBERS, *RAW_DECIMALS])},
        {", ".join(f"NULLIF({n}, '') AS {n}" for n in RAW_TEXTS)},
        CASE WHEN place > 0 THEN CAST(CAST(place AS BIGINT) AS VARCHAR) ELSE 'UNKNOWN' END AS finish_place,
        CASE line WHEN 1 THEN price WHEN 2 THEN CONCAT(price, ' PLN') WHEN 4 THEN '0' END AS prize_amount FROM s""",
)
def _(spark, sf):
    places = {path: name for name, path in {**RAW_NUMBERS, **RAW_DECIMALS, **RAW_TEXTS}.items()}
    tree = {}
    for path, name in places.items():
        *outer, last = path.split(".")
        at = tree
        for part in outer:
            at = at.setdefault(part, {})
        at[last] = F.col(name)

    def built(node):
        return F.struct(*[(built(v) if isinstance(v, dict) else v).alias(k) for k, v in node.items()])

    tree.update(place=F.col("place"), prize=F.parse_json(F.expr(RAW_PRIZE)))
    doc = F.to_json(F.array(built(tree)))
    raw = over(spark, sf, RAW_STARTS).select(F.from_json(doc, schema.RAW_RACES).alias("races"))
    return raw.select(F.inline(normalize.normalize_races(F.col("races"))))


def raw_horses(spark, sf):
    """Every part as a raw horse with a career of five entries in two seasons."""
    size, price = F.col("p_size").cast("long"), F.col("p_retailprice").cast("string")

    def entry(year, kind, prize):
        return F.struct(
            (F.lit(year) + size if year else F.lit(None)).cast("long").alias("raceYear"),
            F.lit(kind).cast("string").alias("raceType"),
            size.alias("raceCount"),
            prize.cast("string").alias("prize"),
        )

    none = F.lit(None)
    career = F.array(
        entry(None, None, F.lit("500 PLN")),
        entry(1975, "Sulki", none),
        entry(None, None, F.concat(price, F.lit(" EUR"))),
        entry(1976, "", none),
        entry(1975, "Sulki", none),
        entry(None, None, F.lit("100,5 zł")),
    )
    horse = F.struct(
        F.col("p_name").alias("name"),
        F.lit("").alias("suffix"),
        size.alias("dateOfBirth"),
        F.col("p_type").alias("sex"),
        F.struct((F.col("p_partkey") % 7).alias("id")).alias("father"),
        F.array(F.struct((F.col("p_partkey") % 25).alias("id"))).alias("breeders"),
        F.array(F.struct(F.col("p_brand").alias("name"))).alias("raceOwners"),
        F.when(size > 25, F.lit(True)).alias("horseFromPolishBreeding"),
    )
    race = F.struct(F.col("p_retailprice").alias("prize"), F.struct(F.col("p_partkey").alias("id")).alias("race"))
    return given(spark, sf, "part").select(
        F.col("p_partkey").alias("horse_id"),
        F.from_json(F.to_json(horse), schema.RAW_HORSE).alias("horse"),
        F.from_json(F.to_json(career), schema.RAW_CAREER).alias("career"),
        F.when(size > 25, F.from_json(F.to_json(F.array(race)), schema.RAW_RACES)).alias("races"),
    )


@query(
    "normalize_horse",
    f"""WITH h AS (SELECT p_partkey AS horse_id, p_name AS horse_name, CAST(NULL AS VARCHAR) AS horse_country,
            CAST(p_size AS BIGINT) AS birth_year, p_type AS horse_sex, NULLIF(p_partkey % 7, 0) AS father_id,
            NULLIF(p_partkey % 25, 0) AS breeder_id, p_brand AS owner_name, p_size > 25 AS polish_breeding,
            FALSE AS foreign_training, p_retailprice AS price FROM part)
        SELECT * EXCLUDE (price), CAST(CASE WHEN birth_year > 25 THEN 1 ELSE 0 END AS BIGINT) AS n_races,
               CASE WHEN birth_year > 25 THEN horse_id END AS first_race,
               {dbl("CASE WHEN birth_year > 25 THEN price END", "first_prize")}, 1975 + birth_year AS race_year, 'Sulki' AS race_type,
               birth_year AS race_count, {dbl("price * 4.25 + 100.5", "prize_amounts")} FROM h
        UNION ALL
        SELECT * EXCLUDE (price), CAST(CASE WHEN birth_year > 25 THEN 1 ELSE 0 END AS BIGINT),
               CASE WHEN birth_year > 25 THEN horse_id END, CASE WHEN birth_year > 25 THEN price END, 1976 + birth_year, NULL, birth_year, 0 FROM h""",
)
def _(spark, sf):
    staged = normalize.normalize_horse(raw_horses(spark, sf))
    names = "horse_id horse_name horse_country birth_year horse_sex father_id breeder_id owner_name polish_breeding foreign_training"
    first = F.get("races", F.lit(0))
    races = [
        F.size("races").cast("long").alias("n_races"),
        first["race_id"].alias("first_race"),
        first["prize_amount"].cast("double").alias("first_prize"),
    ]
    wide = staged.select(*names.split(), *races, F.inline("career"))
    return wide.select(*names.split(), "n_races", "first_race", "first_prize", "race_year", "race_type", "race_count", "prize_amounts")


@query(
    "normalize_reference",
    """SELECT 'jockey' AS kind, s_suppkey AS id, s_name AS last_name, CAST(NULL AS VARCHAR) AS first_name,
              CAST(s_nationkey AS VARCHAR) AS licence_country FROM supplier
       UNION ALL
       SELECT 'trainer', s_suppkey, s_name, NULL, CAST(s_nationkey AS VARCHAR) FROM supplier
       UNION ALL
       SELECT 'breeder', c_custkey, c_name, NULLIF(c_mktsegment, 'BUILDING'), NULL FROM customer""",
)
def _(spark, sf):
    licence = F.struct(F.col("s_nationkey").cast("string").alias("alfa3"))
    person = F.struct(F.col("s_name").alias("lastName"), F.lit("").alias("firstName"), licence.alias("licenceCountry"))
    people = given(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), person.alias("person"))
    jockeys, trainers = (
        normalize.normalize_person(people.withColumnRenamed("id", f"{kind}_id"), f"{kind}_id").select(
            F.lit(kind).alias("kind"), F.col(f"{kind}_id").alias("id"), "last_name", "first_name", "licence_country"
        )
        for kind in ("jockey", "trainer")
    )
    city = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment")).alias("city")
    breeder = F.struct(F.col("c_name").alias("name"), city).alias("breeder")
    bred = normalize.normalize_breeder(
        given(spark, sf, "customer").select(F.col("c_custkey").alias("breeder_id"), breeder)
    )
    return jockeys.unionByName(trainers).unionByName(
        bred.select(
            F.lit("breeder").alias("kind"),
            F.col("breeder_id").alias("id"),
            F.col("name").alias("last_name"),
            F.col("city").alias("first_name"),
            F.lit(None).cast("string").alias("licence_country"),
        )
    )


# ---- keys and text ----------------------------------------------------------
@query(
    "record_key",
    f"SELECT {TEXT_KEY} AS record, COUNT(*) AS n, CAST(1 AS BIGINT) AS keys FROM race_records GROUP BY 1",
    "race_records",
)
def _(spark, sf):
    """Equal texts share one key, and scratched starters keep keys of their own."""
    parts = F.col("horse_id"), F.col("race_id"), F.col("start_order")
    rows = view(spark, sf, "race_records").select(
        S.record_text(*parts).alias("record"), S.record_key(*parts).alias("_key")
    )
    return rows.groupBy("record").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("_key").alias("keys"))


@query("unaccent", "SELECT doc_id, md5(strip_accents(text)) AS digest, length(text) AS n_chars FROM documents")
def _(spark, sf):
    plain = S.unaccent(F.col("text"))
    return given(spark, sf, "documents").select(
        "doc_id", F.md5(plain.cast("binary")).alias("digest"), F.length(plain).cast("long").alias("n_chars")
    )


# Race cards typed by hand: padded, upper-cased names, some of them unknown.
CARDS = """
SELECT o_orderkey AS starting_pos, CONCAT('  ', UPPER(c_name), ' ') AS horse_name,
       CONCAT('supplier#00000', CAST(1000 + o_orderkey % 700 AS VARCHAR(10)), ' ') AS jockey_last_name,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CONCAT('SUPPLIER#0000000', CAST(10 + o_custkey % 60 AS VARCHAR(10))) END AS trainer_last_name,
       o_totalprice / 10000 AS jockey_weight
FROM orders JOIN customer ON c_custkey = o_custkey
"""


@query(
    "name_match",
    f"""WITH e AS ({CARDS})
        SELECT e.starting_pos AS starting_position, e.horse_name, e.jockey_last_name, e.trainer_last_name,
               h.c_custkey AS horse_id, t.trainer_id, j.jockey_id, e.jockey_weight
        FROM e LEFT JOIN customer h ON LOWER(TRIM(h.c_name)) = LOWER(TRIM(e.horse_name))
        LEFT JOIN jockeys j ON LOWER(TRIM(j.last_name)) = LOWER(TRIM(e.jockey_last_name))
        LEFT JOIN trainers t ON LOWER(TRIM(t.last_name)) = LOWER(TRIM(e.trainer_last_name))""",
    "jockeys trainers",
)
def _(spark, sf):
    t = racing(spark, sf)
    named = given(spark, sf, "customer").select(
        F.col("c_custkey").alias("horse_id"), F.col("c_name").alias("horse_name")
    )
    known = RacingTables(named, t.horse_careers, t.races, t.race_records, t.jockeys, t.trainers, t.breeders)
    out = resolve_names(over(spark, sf, CARDS), known)
    return out.select(
        "starting_position", "horse_name", "jockey_last_name", "trainer_last_name",
        "horse_id", "trainer_id", "jockey_id", "jockey_weight",
    )


# Names as they are kept, with Polish letters, and as they are typed: plain capitals,
# accents of another place, blanks.
KEPT_NAMES = "SELECT c_custkey AS horse_id, REPLACE(REPLACE(REPLACE(REPLACE(c_name, 'C', 'Ć'), 'u', 'ü'), 's', 'ś'), 'm', 'mł') AS horse_name FROM customer"
TYPED_NAMES = """
SELECT o_orderkey AS starting_pos, CASE o_orderkey % 4
    WHEN 0 THEN CONCAT('  ', REPLACE(UPPER(c_name), 'M', 'ML'), ' ') WHEN 1 THEN REPLACE(LOWER(c_name), 'm', 'mł')
    WHEN 2 THEN REPLACE(REPLACE(c_name, 'o', 'ó'), 'm', 'mł') ELSE c_name END AS horse_name,
    CAST(NULL AS VARCHAR(9)) AS jockey_last_name, CAST(NULL AS VARCHAR(9)) AS trainer_last_name
FROM orders JOIN customer ON c_custkey = o_custkey
"""


def folded(name: str) -> str:
    return f"LOWER(REPLACE(REPLACE(strip_accents(TRIM({name})), 'ł', 'l'), 'Ł', 'L'))"


@query(
    "name_match_lenient",
    f"""WITH k AS ({KEPT_NAMES}), e AS ({TYPED_NAMES})
        SELECT e.starting_pos AS starting_position, e.horse_name, k.horse_id
        FROM e LEFT JOIN k ON {folded("k.horse_name")} = {folded("e.horse_name")}""",
)
def _(spark, sf):
    """Names joined by collation: whatever the case, accents and blanks."""
    t = racing(spark, sf)
    known = RacingTables(over(spark, sf, KEPT_NAMES), t.horse_careers, t.races, t.race_records, t.jockeys, t.trainers, t.breeders)
    out = resolve_names(over(spark, sf, TYPED_NAMES), known, lenient=True)
    return out.select("starting_position", F.col("horse_name").cast("string").alias("horse_name"), "horse_id")


@query(
    "inline_entries",
    """SELECT c_custkey AS horse_id, CAST(1 AS BIGINT) AS start_pos, CAST(c_nationkey AS BIGINT) AS jockey_id, 55.0::DOUBLE AS jockey_weight_kg FROM customer
       UNION ALL
       SELECT c_custkey, 2, c_custkey % 100, 56.5 FROM customer""",
)
def _(spark, sf):
    entry = lambda pos, jockey, weight: F.struct(
        F.col("c_custkey").alias("horse_id"),
        F.lit(pos).cast("long").alias("start_pos"),
        jockey.cast("long").alias("jockey_id"),
        F.lit(weight).alias("jockey_weight_kg"),
    )
    pair = F.array(entry(1, F.col("c_nationkey"), 55.0), entry(2, F.col("c_custkey") % 100, 56.5))
    return inline_entries(given(spark, sf, "customer").select(pair.alias("entries")))
