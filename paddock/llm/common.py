"""Shared pieces: exact ranks without one-task groups, row keys, settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paddock.session import materialize, scratch_path, tune

__all__ = ["Names", "ascii_lower", "bucket_bits", "columns_of", "materialize", "packed", "prepared", "ranked", "row_keys", "scratch_path", "seeded", "source_key", "table", "unpacked"]

HASH_BITS = 60
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def prepared(spark: SparkSession) -> SparkSession:
    """Runtime settings of this subpackage: Arrow batches of few rows, because a
    row may hold a very long text, and Spark's own limits for generated methods,
    broadcasts and dealt rows."""
    tune(spark)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "true")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


class Names:
    """Column names that a table does not have (whatever their case), for columns
    that an operator adds for a while."""

    def __init__(self, df: DataFrame, *others: str):
        self.taken = {c.lower() for c in [*df.columns, *others]}

    def new(self, *labels: str) -> str | list[str]:
        made = []
        for label in labels:
            name = f"_{label}"
            while name.lower() in self.taken:
                name = f"_{name}"
            self.taken.add(name.lower())
            made.append(name)
        return made if len(made) > 1 else made[0]


def columns_of(df: DataFrame) -> list[Column]:
    """All columns, whatever their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def packed(df: DataFrame, **needed: Column) -> DataFrame:
    """Whole rows as one column ``row``, beside columns of other names made from them:
    what an operator adds for a while can't meet a column of the table."""
    return df.select(F.struct(*columns_of(df)).alias("row"), *[c.alias(name) for name, c in needed.items()])


def unpacked(df: DataFrame, columns: list[str], *made: str) -> DataFrame:
    """The columns of packed rows, but for those that ``made`` ones replace."""
    kept = [F.col("row").getField(c).alias(c) for c in columns if c.lower() not in {m.lower() for m in made}]
    return df.select(*kept, *made)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. ``lower`` does just that, and faster,
    unless the text has a cased letter outside ASCII."""
    other = text.rlike("[[^\\x00-\\x7F]&&[\\p{Lu}\\p{Lt}\\u0345\\u2160-\\u216F\\u24B6-\\u24CF]]")
    return F.when(other, F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def row_keys(df: DataFrame) -> tuple[Column, Column]:
    """Two hashes over all columns of a row, 96 bits together. Equal rows have
    equal keys, so what is joined by them treats repeated rows alike."""
    cols = [F.to_json(df[c]) if kind.startswith("map") else df[c] for c, kind in df.dtypes]
    return F.xxhash64(*cols), F.hash(*cols)


def source_key(source: Column) -> Column:
    """A key that is never null and keeps null apart from any text."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def seeded(seed: int, *parts: Column) -> Column:
    """A uniform integer of 60 bits, the same in every run and engine."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def bucket_bits(rows: int, per_bucket: int = 20_000, least: int = 8) -> int:
    """log2 of how many hash buckets keep a bucket near ``per_bucket`` rows."""
    return max(least, (max(rows, 1) // per_bucket).bit_length())


def ranked(df: DataFrame, keys: list[str], bucket: str, order: list, rank: str, total: str = None) -> DataFrame:
    """Add each row's exact rank (from 0) within ``keys``, ordered by ``bucket``
    and then ``order``; ``total`` adds the number of rows of the key.

    No task holds a key: rows are numbered within (keys, bucket), and the counts
    of earlier buckets are added. ``df`` is read twice. Keys are not null.
    """
    counts = df.groupBy(*keys, bucket).agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    if total:
        starts = starts.withColumn(total, F.sum("_rows").over(Window.partitionBy(*keys)))
    within = Window.partitionBy(*keys, bucket).orderBy(*order)
    numbered = df.withColumn("_number", F.row_number().over(within) - 1)
    joined = numbered.join(starts.drop("_rows"), [*keys, bucket])
    return joined.withColumn(rank, F.col("_start") + F.col("_number")).drop("_start", "_number")
