"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm import decontamination, langid, licensing, minhash, mixing, preferences, repair, sharding, simhash, spotsigs, tokens, trie, warc
from paddock.llm.common import materialize, scratch_path, table
from paddock.llm.oracles import SQL

QUERIES, ORACLES = {}, {}


def query(fn):
    QUERIES[fn.__name__] = fn
    if fn.__name__ in SQL:
        ORACLES[fn.__name__] = SQL[fn.__name__].strip()
    return fn


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt to eight shards in the mixture's proportions."""
    docs = table(spark, sf_dir, "documents")
    crc = F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias("text_crc32")
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size")
    rows = materialize(docs.select("doc_id", "source", size, crc), "rows")
    placed = sharding.interleave(rows, shards=8, salt=("size", "text_crc32"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents inside windows of 13 words of benchmark items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"), keep=("doc_id",))
    rows = found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        decontamination.contaminated().alias("contaminated"),
    )


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, by a network that never saw a third of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identified(docs)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document a weighted mix of the sources takes."""
    docs = table(spark, sf_dir, "documents")
    rows = materialize(docs.select("doc_id", "source", mixing.n_words(F.col("text")).alias("size")), "sizes")
    taken = mixing.sampled(rows, "size")
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that every document states."""
    found = licensing.scanned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "licenses", "sentence_ids", "n_unknown", "status")


@query
def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as token ids, written in coded blocks and read back."""
    import public_tokenizers

    path = scratch_path(spark, "token-blocks")
    tokens.write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return tokens.read_summary(spark.read.parquet(path))


@query
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as a preference pair: its own last reply, and another's."""
    pairs = preferences.with_borrowed_replies(table(spark, sf_dir, "conversations"))
    return preferences.formatted(pairs)


@query
def op9_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness."""
    rows = spotsigs.compared(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        spotsigs.fingerprint(F.col("signatures")).alias("fingerprint"),
        spotsigs.fingerprint(F.col("edited_signatures")).alias("edited_fingerprint"),
        spotsigs.likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"),
        spotsigs.likeness(F.col("signatures"), F.col("next_signatures")).alias("near_next"),
    )


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page."""
    return warc.derived(warc.page_responses(table(spark, sf_dir, "pages")))


@query
def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults put into every conversation, what they are, and the cheapest repair."""
    given = table(spark, sf_dir, "conversations")
    rows = repair.damaged(given)
    audits = materialize(repair.audited(rows, given), "audits")
    return repair.digested(rows, audits)


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all rebuilt conversations."""
    return trie.prefix_trie(trie.rebuilt(table(spark, sf_dir, "conversations")))


@query
def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document, by sets of 4-word shingles."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", kept.alias("kept"))
