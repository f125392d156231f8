"""Keys by FARM_FINGERPRINT, checked with 128-bit arithmetic in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from paddock import schema
from paddock.functions import farm
from paddock.functions import scalars as S
from paddock.plans import ingest
from paddock.session import scratch_path
from paddock.sources.tables import base_table
from suite.fixtures import over, view
from suite.ingest_queries import TEXT_KEY, race_docs, stored
from suite.registry import query

M = "CAST(18446744073709551616 AS UHUGEINT)"
K1, K2 = (f"CAST({k % 2**64} AS UHUGEINT)" for k in (farm.K1, farm.K2))


def word(at: str, width: int = 8) -> str:
    return f"list_reduce(list_prepend(CAST(0 AS UHUGEINT), list_reverse(bytes[{at} + 1:{at} + {width}])), lambda a, x: a * CAST(256 AS UHUGEINT) + x)"


def mul(a: str, b: str) -> str:
    return f"(({a}) * ({b}) % {M})"


def add(*parts: str) -> str:
    return f"(({' + '.join(parts)}) % {M})"


def turn(a: str, bits: int) -> str:
    return f"(({a} >> CAST({bits} AS UHUGEINT)) + ({a} << CAST({64 - bits} AS UHUGEINT)) % {M})"


def two(u: str, v: str) -> str:
    def mixed(a):
        return f"xor({a}, {a} >> CAST(47 AS UHUGEINT))"

    a = mixed(mul(f"xor({u}, {v})", "mul"))
    return mul(mixed(mul(f"xor({v}, {a})", "mul")), "mul")


def fingerprints(texts: str) -> str:
    """CTEs up to ``farmed`` (the columns of ``texts`` and ``key``) for texts of 4 to
    64 bytes; each step of the hash is a column."""
    by_size = {
        "u": (f"CAST(n AS UHUGEINT) + {word('0', 4)} * CAST(8 AS UHUGEINT)", add(mul(turn("b8", 37), "mul"), "a8"), add(turn(add("a", "b"), 43), turn("c", 30), "d")),
        "v": (word("n - 4", 4), mul(add(turn("a8", 25), "b8"), "mul"), add("a", turn(add("b", K2), 18), "c")),
    }
    u, v = (f"CASE WHEN n < 8 THEN {x[0]} WHEN n <= 16 THEN {x[1]} ELSE {x[2]} END" for x in by_size.values())
    return f"""
bytes AS (
    SELECT *, strlen(text) AS n, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda p: CAST(CAST('0x' || p AS BIGINT) AS UHUGEINT)) AS bytes
    FROM ({texts})),
words AS (
    SELECT *, {K2} + CAST(n * 2 AS UHUGEINT) AS mul, {add(word("0"), K2)} AS a8, {word("n - 8")} AS b8, {mul(word("0"), f"CASE WHEN n <= 32 THEN {K1} ELSE {K2} END")} AS a,
           {word("8")} AS b, {mul(word("n - 8"), f"({K2} + CAST(n * 2 AS UHUGEINT))")} AS c, {mul(word("n - 16"), K2)} AS d
    FROM bytes),
seeds AS (SELECT *, {u} AS u, {v} AS v FROM words),
short AS (SELECT *, {two("u", "v")} AS z FROM seeds),
inner64 AS (
    SELECT *, {mul(word("16"), "mul")} AS e, {word("24")} AS f, {mul(add("u", word("n - 32")), "mul")} AS g, {mul(add("z", word("n - 24")), "mul")} AS h
    FROM short),
seeds64 AS (SELECT *, {add(turn(add("e", "f"), 43), turn("g", 30), "h")} AS u64, {add("e", turn(add("f", "a"), 18), "g")} AS v64 FROM inner64),
hashed AS (SELECT *, CASE WHEN n <= 32 THEN z ELSE {two("u64", "v64")} END AS hash FROM seeds64),
farmed AS (SELECT *, CAST(CASE WHEN hash >= 9223372036854775808 THEN CAST(hash AS HUGEINT) - 18446744073709551616 ELSE CAST(hash AS HUGEINT) END AS BIGINT) AS key
           FROM hashed)"""


TEXTS = f"""SELECT 'record' AS kind, {TEXT_KEY} AS text FROM race_records
    UNION ALL SELECT 'customer', c_name FROM customer
    UNION ALL SELECT 'pair', CONCAT(c_name, ' & ', c_name, ' ', c_mktsegment) FROM customer"""


@query("farm_fingerprint", f"WITH {fingerprints(TEXTS)} SELECT kind, text, key FROM farmed", "race_records")
def _(spark, sf):
    """FARM_FINGERPRINT of short and long texts."""
    records = view(spark, sf, "race_records")
    texts = records.select(F.lit("record").alias("kind"), S.record_text(F.col("horse_id"), F.col("race_id"), F.col("start_order")).alias("text"))
    names = over(spark, sf, "SELECT c_name, c_mktsegment FROM customer")
    texts = texts.unionByName(names.select(F.lit("customer").alias("kind"), F.col("c_name").alias("text")))
    pair = F.concat("c_name", F.lit(" & "), "c_name", F.lit(" "), "c_mktsegment")
    texts = texts.unionByName(names.select(F.lit("pair").alias("kind"), pair.alias("text")))
    return texts.select("kind", "text", farm.fingerprint(F.col("text")).alias("key"))


@query(
    "merge_exported_records",
    f"""WITH {fingerprints(f"SELECT *, {TEXT_KEY} AS text FROM race_records")},
        one AS (SELECT key, COUNT(*) AS n FROM farmed GROUP BY key)
        SELECT key AS race_record_id, (SELECT COUNT(*) FROM one) AS staged, (SELECT COUNT(*) FROM one) AS updated,
               CAST(0 AS BIGINT) AS inserted FROM one""",
    "race_records",
)
def _(spark, sf):
    """A feed merged into a table whose keys were made elsewhere adds no row. The
    exported keys are those of the SQL function, not of the plan under test."""
    records = view(spark, sf, "race_records")
    farm.register(spark)
    records.createOrReplaceTempView("exported")
    key = f"farm_fingerprint({TEXT_KEY.replace('VARCHAR', 'STRING')}) AS race_record_id"
    exported = spark.sql(f"SELECT DISTINCT {key} FROM exported")
    target = base_table(spark, scratch_path(spark, "lake"), "race_records")
    target.write(stored(exported, schema.RACE_RECORDS))
    counts = target.merge(ingest.staged_records(race_docs(records)), F.current_timestamp())
    return target.read().select("race_record_id", *[F.lit(n).cast("long").alias(c) for c, n in counts.items()])
