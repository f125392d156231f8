"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Runtime settings every job relies on. They are SQL settings, so they can also
# be put on a session that somebody else built.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits the hot partitions of a shuffled join at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A measured side up to this size is broadcast, so the other is not shuffled.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # Rows dealt by one key meet others on that and a further key where they are.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # The JVM never compiles a method of more bytecode; the projection of a wide
    # feature table is then better cut into several methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str = None, app: str = "paddock", **extra) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    named = tempfile.mkdtemp(prefix="paddock-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, free_shuffles: bool = False, **options) -> DataFrame:
    """Write a result used by several branches once and read it back.

    Being a table in shared storage it survives lost executors, and its known
    size lets the optimizer decide by itself whether it may be broadcast.
    With ``free_shuffles`` what was shuffled for it leaves the executors' disks once it is
    written, and not only when the driver happens to collect garbage. ``options`` are
    those of the writer.
    """
    path = scratch_path(df.sparkSession, label)
    with settings(df.sparkSession, {FREED: "true"} if free_shuffles else {}):
        df.write.options(**{"compression": "zstd", **options}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(stored: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote and that nothing reads any more."""
    spark = stored.sparkSession
    folders = {f.rpartition("/")[0] for f in stored.inputFiles()}
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


LOOKUP_BYTES = 128 << 20


def lookup(df: DataFrame, label: str) -> DataFrame:
    """A stored table of keys that much larger rows are to meet, broadcast up to
    ``LOOKUP_BYTES`` as counted while it was written.

    Left to the adaptive planner it depends on which stage ends first whether the larger
    rows are shuffled.
    """
    seen = Observation()
    stored = materialize(df.observe(seen, F.count(F.lit(1)).alias("n")), label)
    return F.broadcast(stored) if seen.get["n"] * 10 * (len(df.columns) + 2) <= LOOKUP_BYTES else stored


@contextmanager
def settings(spark: SparkSession, values: dict):
    """Settings of the session for a while."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def file_parts(spark: SparkSession, count: int):
    """Files are read in at least ``count`` parts, as far as their row groups allow."""
    return settings(spark, {"spark.sql.files.minPartitionNum": max(count, spark.sparkContext.defaultParallelism)})
