"""From raw documents to shards of a training mix, stage by stage.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and is
written as Parquet, which the next one reads. All but the last return the columns
of documents, and further columns of any names are kept. Without rows, no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm.common import materialize, packed, prepared, table, unpacked
from paddock.llm.decontamination import decontaminated
from paddock.llm.langid import accepted
from paddock.llm.mixing import mixed
from paddock.llm.sharding import interleave
from paddock.llm.simhash import deduplicated


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows. Those that go: null and empty
    texts, texts without a letter, and text that looks like none of the languages learned
    from ``docs``. Repeated rows share their fate."""
    prepared(spark)
    return accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id (null
    last); of repeated rows one stays. Null and empty texts are copies of each other."""
    prepared(spark)
    return deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that hold passages of the benchmark. Null and empty texts
    are clean; repeated rows share their fate."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the weights of the sources ask for, repeated rows each on
    its own. A null source is a source; a null or empty text has no words and is drawn
    with its source like any other."""
    prepared(spark)
    return mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Eight shards of the same mixture; adds shard and slot (columns of these names are
    replaced). Every row gets a place; rows of one id, or without an id, are ordered by a
    hash of their text."""
    prepared(spark)
    rows = packed(docs, doc_id=F.col("doc_id"), source=F.col("source"), text_hash=F.xxhash64("text"))
    placed = interleave(rows.withColumnRenamed("row", "doc"), shards=8, salt=("text_hash",))
    return unpacked(placed.withColumnRenamed("doc", "row"), docs.columns, "shard", "slot")


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

# Language identification by a trained network is no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
