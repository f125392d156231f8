"""SpotSigs fingerprints of documents.

Wherever a very common word (an anchor) occurs, it and the next content words
after it form a signature. The set of a text's signatures is its fingerprint, and
the likeness of two texts is the Jaccard coefficient of their sets. Expressions of
Spark only.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paddock.llm.common import bucket_bits, materialize

# Very common words of four languages.
ANCHORS = """a an and are as at be by de das dem den der des die du ein eine el en es et est for from has il im in is it la
las le les lo los mit nicht no of on or para pas por pour que qui se sich sur that the this to un una und une von was with y
zu""".split()
CHAIN = 2
SIGNATURE_DIGITS = 8
WORD = r"[\p{L}\p{N}]+"


def signature(text: Column) -> Column:
    return F.substring(F.md5(text), 1, SIGNATURE_DIGITS)


def with_signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add the sorted set of signatures of a text column, each eight hex digits.

    Chains skip other anchors. A text without any chain has one signature, of its
    whole word sequence; without any word (null and empty included), of the empty
    one. So no set is empty, and equal texts have equal sets.
    """
    is_anchor = lambda w: w.isin(ANCHORS)
    df = df.withColumn("_w", F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0)))
    places = F.filter(F.transform("_w", lambda w, i: F.when(is_anchor(w), i)), lambda i: i.isNotNull())
    df = df.withColumns({"_content": F.filter("_w", lambda w: ~is_anchor(w)), "_places": places})
    # Before the j-th anchor, at place p, there are p - j content words.
    complete = F.filter("_places", lambda p, j: p - j + CHAIN <= F.size("_content"))
    chains = F.transform(
        complete, lambda p, j: signature(F.concat_ws(" ", F.get("_w", p), *[F.get("_content", p - j + i) for i in range(CHAIN)]))
    )
    df = df.withColumn(out, F.array_sort(F.array_distinct(chains)))
    whole = F.array(signature(F.array_join("_w", " ")))
    return df.withColumn(out, F.when(F.size(out) > 0, F.col(out)).otherwise(whole)).drop("_w", "_content", "_places")


def fingerprint(signatures: Column) -> Column:
    return F.array_join(signatures, "")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard coefficient, or 0 if the sizes alone keep it below ``least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    exact = shared.cast("double") / (F.size(a) + F.size(b) - shared)
    return F.when(small < large * F.lit(least), F.lit(0.0)).otherwise(exact) if least else exact


def edited(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_chars, next_text and edited_text of every document: the
    last half of its characters gives way to the first as many of the next one, by
    descending doc_id (after the last: the first).

    Null texts count as empty. Null ids come last; documents of one id are ordered
    by a hash of their texts. The order is cut into ranges of ids by quantiles, so
    each text is shuffled once; the first document of the next range is joined.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ids = rows.select(F.col("doc_id").cast("double").alias("at"))
    n = ids.count()
    ranges = 1 << bucket_bits(n, per_bucket=2_000, least=6)
    ranges = min(ranges, 1 << 14)
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    cuts = ids.agg(F.percentile_approx("at", shares, 10 * ranges)).first()[0] or []
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    rows = rows.withColumn("_at", F.col("doc_id").cast("double"))
    if len(splits) > 2:
        rows = Bucketizer(splits=splits, inputCol="_at", outputCol="_range", handleInvalid="keep").transform(rows)
        rows = rows.withColumn("_range", F.when(F.col("_at").isNull(), -1).otherwise(F.col("_range").cast("int")))
    else:
        rows = rows.withColumn("_range", F.when(F.col("_at").isNull(), -1).otherwise(0))
    rows = rows.drop("_at").withColumn("_hash", F.xxhash64("text"))
    # The first document of each range, and the range that follows it.
    heads = rows.groupBy("_range").agg(F.max(F.struct("doc_id", "_hash")).alias("head")).select("_range", "head.*")
    heads = materialize(heads, "heads")
    texts = rows.join(F.broadcast(heads), (rows["_range"] == heads["_range"]) & rows["doc_id"].eqNullSafe(heads["doc_id"]) & (rows["_hash"] == heads["_hash"]))
    texts = texts.select(rows["_range"], rows["text"]).groupBy("_range").agg(F.first("text").alias("head_text"))
    down = Window.orderBy(F.col("_range").desc())
    wrap = F.first("_range").over(down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    order = heads.select("_range", F.coalesce(F.lead("_range").over(down), wrap).alias("_next"))
    following = order.join(texts.withColumnRenamed("_range", "_next"), "_next").select("_range", "head_text")
    within = Window.partitionBy("_range").orderBy(F.col("doc_id").desc_nulls_last(), F.col("_hash").desc())
    rows = rows.withColumn("_lead", F.lead("text").over(within)).join(following, "_range")
    rows = rows.withColumn("next_text", F.coalesce("_lead", "head_text")).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    new = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    return rows.select("doc_id", "text", "n_chars", "next_text", new.alias("edited_text"))


def compared(docs: DataFrame) -> DataFrame:
    """Rows of ``edited`` with the sets of the text, the edited text and the next
    text (signatures, edited_signatures, next_signatures)."""
    rows = edited(docs)
    for text, out in (("text", "signatures"), ("edited_text", "edited_signatures"), ("next_text", "next_signatures")):
        rows = with_signatures(rows, text, out)
    return rows


def similar_pairs(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs (a, b, likeness) of fingerprints of different sets whose likeness is
    ``threshold`` or more; documents belong to a fingerprint by ``fingerprint``.

    Sets are partitioned by their length into ranges so wide that similar sets
    fall into the same or neighbouring ones. Within them they meet on one of their
    rarest signatures: sets that share none of the first |s| - t|s| + 1 can't reach
    the threshold t. Pairs of unfit lengths are pruned before they are compared.
    """
    rows = with_signatures(docs.select("text"), "text", "sigs")
    sets = materialize(rows.withColumn("fingerprint", F.sha2(fingerprint(F.col("sigs")), 256)).dropDuplicates(["fingerprint"]).drop("text"), "sets")
    size = F.size("sigs")
    # Lengths of one range differ by less than the factor 1 / threshold.
    lengths = F.floor(F.log(1 / threshold, size) + 1e-9)
    words = sets.select("fingerprint", size.alias("size"), lengths.alias("range"), F.explode("sigs").alias("sig"))
    frequency = words.groupBy("sig").agg(F.count("*").alias("n"))
    ranks = words.join(frequency, "sig").withColumn("rank", F.row_number().over(Window.partitionBy("fingerprint").orderBy("n", "sig")))
    prefix = materialize(ranks.where(F.col("rank") <= F.col("size") - F.ceil(F.col("size") * threshold) + 1).select("fingerprint", "size", "range", "sig"), "prefix")
    right = prefix.withColumn("range", F.explode(F.array(F.col("range"), F.col("range") + 1)))
    a, b = prefix.alias("a"), right.alias("b")
    met = a.join(b, (F.col("a.range") == F.col("b.range")) & (F.col("a.sig") == F.col("b.sig")))
    fits = F.least("a.size", "b.size") >= F.greatest("a.size", "b.size") * threshold
    met = met.where(fits & (F.col("a.fingerprint") != F.col("b.fingerprint")))
    met = met.select(F.least("a.fingerprint", "b.fingerprint").alias("a"), F.greatest("a.fingerprint", "b.fingerprint").alias("b")).distinct()
    left = sets.select(F.col("fingerprint").alias("a"), F.col("sigs").alias("a_sigs"))
    other = sets.select(F.col("fingerprint").alias("b"), F.col("sigs").alias("b_sigs"))
    scored = met.join(left, "a").join(other, "b").withColumn("likeness", likeness(F.col("a_sigs"), F.col("b_sigs"), threshold))
    return scored.where(F.col("likeness") >= threshold).select("a", "b", "likeness")
