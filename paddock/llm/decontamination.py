"""Benchmark decontamination with a broadcast hash set of test n-grams.

Each document is cut into words, every word position probes the hash set with the
first words of a window, a hit is verified against the whole window, and the word
spans found decide what is removed. Expressions of Spark only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.llm.common import Names, ascii_lower, columns_of, materialize, row_keys

N = 13
ANCHOR = 3
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same words in a text that still has its capitals, each with what follows.
CHUNK = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
LEAD = r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
BROADCAST_BYTES = 64 << 20


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def anchor(array: Column, at: Column, length: int) -> Column:
    """Hash of the ``length`` words from index ``at`` (from 0)."""
    return F.xxhash64(F.lit(length), *[F.get(array, at + i) for i in range(length)])


def windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """Distinct windows: gram, its length, the ids of the items that hold it."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), words(F.col("text")).alias("w"))
    items = items.where(F.size("w") > 0).withColumn("n", F.least(F.size("w"), F.lit(n)))
    starts = items.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("n"))))
    first = F.when(F.col("n") >= ANCHOR, anchor(F.col("w"), F.col("at"), ANCHOR))
    for length in range(1, ANCHOR):
        first = first.when(F.col("n") == length, anchor(F.col("w"), F.col("at"), length))
    grams = starts.select("item", "n", first.alias("anchor"), F.array_join(F.slice("w", F.col("at") + 1, F.col("n")), " ").alias("gram"))
    return grams.groupBy("anchor", "gram", "n").agg(F.sort_array(F.collect_set("item")).alias("items"))


def found(docs: DataFrame, grams: DataFrame, lengths: list[int], whole: bool) -> DataFrame:
    """Windows found in documents, one row for each place; with ``whole`` also
    one row with n = 0 for each document, at the position after its last word."""
    positions = docs.withColumn("at", F.explode_outer(F.sequence(F.lit(0), F.size("w"))))
    last = F.col("at") == F.size("w")
    probes = [F.when(last, F.lit(0)).otherwise(anchor(F.col("w"), F.col("at"), length)) for length in lengths]
    if len(probes) == 1:
        positions = positions.withColumn("anchor", probes[0])
    else:
        positions = positions.withColumn("anchor", F.explode_outer(F.array_distinct(F.array(*probes))))
    end = docs.sparkSession.createDataFrame([(0, "", 0, [])], grams.select("anchor", "gram", "n", "items").schema)
    known = grams.select("anchor", "gram", "n", "items")
    known = F.broadcast(known.unionByName(end) if whole else known)
    same = (positions["anchor"] == known["anchor"]) & (
        F.concat_ws(" ", F.slice(positions["w"], positions["at"] + 1, known["n"])) == known["gram"]
    )
    return positions.join(known, same & ((known["n"] > 0) == ~last)).drop("anchor", "gram")


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = N, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each distinct row of ``docs`` (of any columns with ``text``):
    its keys _k1 and _k2, the columns of ``keep``, how many ``copies`` it has, n_words, n_hit (words inside
    any window that occurs), spans (start, length) and items.

    Null and empty texts have no words. An item of fewer than ``n`` words, but
    not none, is one window; repeated items hit together; a null item_id is
    listed as ``null``. Without benchmark rows nothing is hit.

    The set is broadcast in blocks of at most BROADCAST_BYTES by the measured
    size of its windows; a larger benchmark takes one pass for each block.
    """
    grams = materialize(windows(benchmark, n), "grams")
    size = F.sum(F.length("gram") + 100 + F.aggregate("items", F.lit(0), lambda a, x: a + F.length(x) + 24))
    got = grams.agg(F.coalesce(size, F.lit(0)).alias("bytes"), F.collect_set(F.least("n", F.lit(ANCHOR))).alias("lengths")).first()
    blocks = got["bytes"] // BROADCAST_BYTES + 1
    lengths = sorted(got["lengths"]) or [ANCHOR]
    k1, k2 = row_keys(docs)
    texts = docs.select(k1.alias("_k1"), k2.alias("_k2"), *keep, words(F.col("text")).alias("w"))
    passes = [
        found(texts, grams if blocks == 1 else grams.where(F.pmod(F.xxhash64("gram"), F.lit(blocks)) == b), lengths, whole=b == 0)
        for b in range(blocks)
    ]
    hits = reduce(DataFrame.unionByName, passes)
    hit, whole = F.col("n") > 0, F.col("n") == 0
    grouped = hits.groupBy("_k1", "_k2", *keep).agg(
        F.count_if(whole).alias("copies"),
        F.max(F.when(whole, F.col("at"))).cast("long").alias("n_words"),
        F.sort_array(F.collect_set(F.when(hit, F.struct("at", "n")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(hit, F.col("items")))))).alias("items"),
    )
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("hit"))

    def extend(a: Column, s: Column) -> Column:
        end = s["at"] + s["n"]
        return F.struct(F.greatest(a["end"], end).alias("end"), (a["hit"] + F.greatest(F.lit(0), end - F.greatest(a["end"], s["at"]))).alias("hit"))

    return grouped.withColumn("n_hit", F.aggregate("spans", start, extend, lambda a: a["hit"]))


def contaminated(least: int = 20) -> Column:
    """At least one word in ``least`` is hit."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * least >= F.col("n_words"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, cut: bool = False, n: int = N) -> DataFrame:
    """Documents without the contaminated ones; with ``cut`` these stay, but the
    spans hit are removed from their texts (with what follows each word).
    Columns are kept as they are; all copies of a row share its fate. Null and
    empty texts are clean, and without benchmark rows all are."""
    k1, k2 = row_keys(docs)
    one, two, spans = Names(docs).new("k1", "k2", "spans")
    keyed = docs.withColumns({one: k1, two: k2})
    bad = contamination(docs, benchmark, n).where(contaminated())
    bad = materialize(bad.select(F.col("_k1").alias(one), F.col("_k2").alias(two), F.col("spans").alias(spans)), "contaminated")
    if not cut:
        return keyed.join(bad, [one, two], "left_anti").drop(one, two)
    chunks = F.regexp_extract_all("text", F.lit(CHUNK), F.lit(0))
    outside = F.filter(chunks, lambda c, i: ~F.exists(spans, lambda s: (i >= s["at"]) & (i < s["at"] + s["n"])))
    rest = F.concat(F.regexp_extract("text", LEAD, 0), F.array_join(outside, ""))
    joined = keyed.join(bad, [one, two], "left")
    return joined.withColumn("text", F.when(F.col(spans).isNull(), F.col("text")).otherwise(rest)).select(*columns_of(docs))
