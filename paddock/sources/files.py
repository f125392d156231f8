"""File discovery, shard merging and the CSV source of upcoming starters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock import schema
from paddock.functions import scalars as S

SHARD_PATTERN = r"^shard_.*\.ndjson$"
# Files whose names the driver holds at a time. A backlog is worked off in such pages.
PAGE = 10_000


def base_name(path: Column) -> Column:
    """Last part of a path; part files count as the directory they belong to."""
    return F.regexp_extract(path, r"([^/]+?)(?:/part-[^/]*)?$", 1)


def list_files(spark: SparkSession, prefix: str) -> DataFrame:
    """``path, created, length`` of the files under a prefix.

    The listing runs on the executors and never opens a file: the content
    column is pruned from the scan.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.load(prefix).select("path", F.col("modificationTime").alias("created"), "length")


def _hadoop(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _hadoop(spark, path)
    return fs.exists(at)


def touch(spark: SparkSession, path: str) -> None:
    """Leave an empty file as a mark."""
    fs, at = _hadoop(spark, path)
    fs.createNewFile(at)


def children(spark: SparkSession, folder: str, pattern: str) -> list[tuple[str, bool]]:
    """Name and whether it is a directory, of what lies in a folder."""
    fs, at = _hadoop(spark, f"{folder.rstrip('/')}/{pattern}")
    return [(s.getPath().getName(), s.isDirectory()) for s in fs.globStatus(at) or []]


def committed(spark: SparkSession, folder: str) -> bool:
    """Whether a job has finished writing a folder."""
    return exists(spark, f"{folder}/_SUCCESS")


def masters_to_clean(spark: SparkSession, folder: str) -> list[str]:
    """Names of the finished masters in a folder that have no finished clean form.
    Masters are plain files or directories that a job wrote."""
    found = children(spark, folder, "MASTERFILE_*.ndjson")
    ready = [name for name, directory in found if not directory or committed(spark, f"{folder}/{name}")]
    return [name for name in ready if not committed(spark, f"{folder}/CLEANED_{name}")]


def select_new_files(listing: DataFrame, watermark=None) -> DataFrame:
    """Cleaned NDJSON files created after the watermark (all of them without one)."""
    name = base_name(F.col("path"))
    wanted = listing.where(name.contains("CLEANED_") & name.endswith(".ndjson"))
    return wanted if watermark is None else wanted.where(F.col("created") > F.lit(watermark))


def discover_new_files(spark: SparkSession, prefix: str, watermark=None) -> DataFrame:
    return select_new_files(list_files(spark, prefix), watermark)


def file_tags(files: DataFrame) -> DataFrame:
    """Staging tag of every file: the stamp in its name, else its creation time."""
    stamp = F.date_format("created", "yyyy-MM-dd'T'HH_mm_ss_SSS'Z'")
    return files.withColumn("tag", S.file_tag(base_name(F.col("path")), stamp))


def shard_lines(spark: SparkSession, prefix: str, pattern: str = SHARD_PATTERN) -> DataFrame:
    """Lines of the shards under a prefix whose file name matches ``pattern``."""
    files = spark.read.option("recursiveFileLookup", "true").text(prefix)
    name = base_name(F.col("_metadata.file_path"))
    return files.where(name.rlike(pattern)).select(F.col("value").alias("line"), name.alias("shard"))


def merge_shards(
    spark: SparkSession, prefix: str, out: str, pattern: str = SHARD_PATTERN, ledger: str = None, page: int = PAGE
) -> int:
    """Write the lines of all matching shards as one master directory.

    The unit is a directory that many tasks write, not one file. Shards are
    left in place. Returns the number of shards; 0 writes nothing. A master that
    is already finished stays as it is, half of one is written anew.

    With ``ledger``, a folder that remembers the shards of each master, shards of
    earlier masters are left out, and their lines are not read again. What a
    master holds is noted before it is written and counts once it is finished. One
    master then takes the first ``page`` new shards; call again, with another ``out``,
    for the rest.
    """
    name = base_name(F.col("path"))
    found = list_files(spark, prefix).where(name.rlike(pattern)).select("path", name.alias("shard"))
    if ledger is None:
        merged = found.select("shard").distinct().count()
        if merged and not committed(spark, out):
            shard_lines(spark, prefix, pattern).select("line").write.mode("overwrite").text(out)
        return merged
    note = f"{ledger}/{out.rsplit('/', 1)[1]}"
    if not committed(spark, out):
        known = merged_paths(spark, ledger, out.rsplit("/", 1)[0])
        new = found if known is None else found.join(known, "path", "left_anti")
        new.orderBy("path").limit(page).write.mode("overwrite").parquet(note)
        paths = [r.path for r in spark.read.schema(found.schema).parquet(note).select("path").collect()]
        if not paths:
            return 0
        spark.read.text(paths).write.mode("overwrite").text(out)
    touch(spark, f"{note}/_MERGED")
    return spark.read.schema(found.schema).parquet(note).select("shard").distinct().count()


def merged_paths(spark: SparkSession, ledger: str, masters: str) -> DataFrame | None:
    """Files that finished masters hold. A note counts if it is marked, or if a job
    died between finishing the master and marking the note."""
    notes = [name for name, _ in children(spark, ledger, "*")]
    for name in notes:
        if not exists(spark, f"{ledger}/{name}/_MERGED") and committed(spark, f"{masters}/{name}"):
            touch(spark, f"{ledger}/{name}/_MERGED")
    done = [f"{ledger}/{n}" for n in notes if exists(spark, f"{ledger}/{n}/_MERGED")]
    return spark.read.schema("path string").parquet(*done) if done else None


def master_name(prefix: str, stamp: str) -> str:
    """``horse_data/`` -> ``horse_data/MASTERFILE_HORSEDATA_<stamp>.ndjson``."""
    tag = prefix.removesuffix("/").replace("_", "").upper()
    return f"{prefix}MASTERFILE_{tag}_{stamp}.ndjson"


def read_upcoming_csv(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema(schema.UPCOMING)
        .option("header", "true")
        .option("enforceSchema", "false")
        .option("mode", "FAILFAST")
        .csv(path)
    )
