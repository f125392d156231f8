"""Mixing sources to target weights by systematic sampling.

Every document of a source expects target / size copies. The expected copies are
summed up within the source, one random offset is added, and a document is taken
once for each whole number that the sum crosses at it. The documents are summed
up from short to long, so the words taken come near the target as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paddock.llm.common import HASH_BITS, bucket_bits, materialize, packed, ranked, seeded, source_key, unpacked

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
OFFSET_BITS = 10


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def size_class(size: Column) -> Column:
    """Number of digits and the first two of them: sizes of one class differ by
    a tenth at most, and there are at most 90 classes for each power of ten."""
    digits = size.cast("string")
    return F.length(digits).cast("long") * 100 + F.substring(digits, 1, 2).cast("long")


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Targets of sources, given one row (_src, source_size, docs) for each.

    Sources in code-point order, null last, get the weights in turn and share
    ``share`` times all sizes; a target stops at ``most`` times its source's size
    and the excess goes to the others by weight. That is one level for all: the
    target is the smaller of the limit and level * weight. Sorted by limit over
    weight, the stopped sources come first. One row per source, in one task.
    """
    by_name = Window.orderBy(F.col("_src") == "n", "_src")
    by_limit = Window.orderBy("_ratio", "_place")
    before, everything = by_limit.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    zero = F.lit(0.0)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    s = sizes.withColumn("_place", F.row_number().over(by_name) - 1).withColumn("_weight", weight)
    s = s.withColumn("_limit", F.col("source_size") * F.lit(most)).withColumn("_ratio", F.col("_limit") / F.col("_weight"))
    left = F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("_limit").over(before), zero)
    of = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), zero)
    s = s.withColumn("_level", left / of)
    level = F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_place", "_level"))).over(everything)["_level"]
    s = s.withColumn("target", F.least("_limit", F.coalesce(level * F.col("_weight"), F.col("_limit"))))
    return s.select("_src", "source_size", "docs", "target")


def sampled(rows: DataFrame, size: str, source: str = "source", key: str = "doc_id", seed: int = 6, salt: tuple[str, ...] = (), most: int = 2) -> DataFrame:
    """Add ``source_size``, ``target`` and ``copies`` (0 to ``most``) to each row.

    The result depends on the source, size, key and salt of rows alone, so reruns
    agree. A null source is a source of its own, last in order; a source without
    words has target 0 and no copies. Equal rows are counted one by one; null keys are
    told apart by the salt; an empty table gives an empty result. Columns of the added
    names are replaced, all others are kept. ``rows`` is read several times: pass a
    table or a cheap plan.
    """
    columns = rows.columns
    salts = {f"salt{i}": F.col(c) for i, c in enumerate(salt)}
    base = packed(rows, _src=source_key(F.col(source)), _h=seeded(seed, F.col(key), F.col(size)), size=F.col(size), key=F.col(key), **salts)
    size, key, salt = "size", "key", tuple(salts)
    sizes = base.groupBy("_src").agg(F.sum(size).alias("source_size"), F.count("*").alias("docs"))
    targets = materialize(source_targets(sizes, most=float(most)), "targets")
    total = targets.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("n")).first()["n"]
    bits = bucket_bits(total, per_bucket=1_000_000, least=6)
    base = base.withColumn("_b", size_class(F.col(size)) * (1 << bits) + F.shiftright("_h", HASH_BITS - bits))
    placed = ranked(base, ["_src"], "_b", ["_h", size, key, *salt], "_r")
    u = F.shiftright(seeded(seed, F.col("_src")), HASH_BITS - OFFSET_BITS) / F.lit(float(1 << OFFSET_BITS))
    placed = placed.join(targets.withColumn("_u", u), "_src")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    crossed = F.floor((F.col("_r") + 1) * F.col("_rate") + F.col("_u")) - F.floor(F.col("_r") * F.col("_rate") + F.col("_u"))
    placed = placed.withColumn("_rate", rate)
    placed = placed.withColumn("copies", F.least(crossed, F.ceil("_rate")).cast("int"))
    return unpacked(placed, columns, "source_size", "target", "copies")


def mixed(docs: DataFrame, seed: int = 6) -> DataFrame:
    """The mix itself: each document as many times as it is taken, with its columns.

    A null or empty text has no words, and whether it is taken is drawn like for any
    other. Documents of one id, or without an id, are told apart by a hash of their
    text; equal rows are drawn one by one. An empty table gives an empty mix.
    """
    words = n_words(F.col("text"))
    rows = packed(docs, doc_id=F.col("doc_id"), source=F.col("source"), words=words, text_hash=F.xxhash64("text"))
    kept = sampled(rows.withColumnRenamed("row", "doc"), "words", seed=seed, salt=("text_hash",)).where("copies > 0")
    times = kept.select(F.col("doc").alias("row"), F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return unpacked(times, docs.columns)
