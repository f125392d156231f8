"""Table sinks and sources on plain files."""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock import schema as shapes
from paddock.operators.merge import CREATED, UPDATED, one_per_key, one_per_key_beside
from paddock.operators.ordered import join_same
from paddock.schema import with_schema
from paddock.session import materialize


@dataclass(frozen=True)
class Buckets:
    """How the rows of a table are dealt: by a hash of ``key`` into ``count`` files,
    each sorted by it. All rows of a key are in one bucket, so a table in which one
    key holds much of the rows should not be bucketed by it."""

    key: str
    count: int


class VersionedTable:
    """A table whose every write is a new directory ``v=<n>``.

    A job may read version n while it writes n + 1. A version counts once its
    ``_SUCCESS`` marker is there, which the committer writes last, so a job that
    dies half-way leaves the previous version in place.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, buckets: Buckets = None):
        self.spark, self.root, self.schema, self.buckets = spark, root.rstrip("/"), schema, buckets

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self, kind: str, mark: str = "/_SUCCESS") -> list[int]:
        """Numbers of the directories ``<kind>=<n>``, in order; committed ones only
        unless another ``mark`` is asked for."""
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}=*{mark}")
        paths = [s.getPath() for s in self._fs().globStatus(pattern) or []]
        return sorted(int((p.getParent() if mark else p).getName().split("=")[-1]) for p in paths)

    def _claim(self) -> int:
        """A number above all in use, that no other writer gets: creating the file
        that stands for it succeeds only once. A dead writer's number stays unused."""
        taken = [n for kind in ("v", "m", "_claim") for n in self._numbers(kind, "")]
        number = max(taken, default=0) + 1
        while not self._fs().createNewFile(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_claim={number}")):
            number += 1
        return number

    def version(self) -> int:
        """Newest committed version, 0 before the first write."""
        return max(self._numbers("v"), default=0)

    def _store(self, df: DataFrame, name: str, counts: dict[str, Column] = None) -> dict:
        """Write a directory of the table, in its buckets if it has any; returns
        ``counts`` (aggregates) of what was written, taken while writing. The mark of
        a bucketed one comes last: without it the files are read as plain ones."""
        path, seen = f"{self.root}/{name}", Observation()
        if self.buckets:
            df = df.repartition(self.buckets.count, self.buckets.key)
        if counts:
            # In the tasks that write: each of them is counted once, however often tried.
            df = df.observe(seen, *[c.alias(n) for n, c in counts.items()])
        if self.buckets is None:
            df.write.option("compression", "zstd").parquet(path)
            return seen.get if counts else {}
        key, count = self.buckets.key, self.buckets.count
        table = f"written_{uuid.uuid4().hex}"
        df.write.bucketBy(count, key).sortBy(key).option("path", path).saveAsTable(table)
        self.spark.sql(f"DROP TABLE {table}")
        self._fs().createNewFile(self._path(f"{path}/_buckets={key}={count}"))
        return seen.get if counts else {}

    def _path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _dealt(self, name: str) -> Buckets | None:
        """How a directory was dealt when it was written."""
        marks = self._fs().globStatus(self._path(f"{self.root}/{name}/_buckets=*")) or []
        if not len(marks):
            return None
        _, key, count = marks[0].getPath().getName().split("=")
        return Buckets(key, int(count))

    def _open(self, names: list[str], schema: T.StructType) -> DataFrame:
        """Rows of some directories of the table; columns that one lacks are null.

        Those dealt alike are read as partitions of one catalog table that lies on
        their files: bucket i then holds the i-th files of all of them, and the
        planner knows how rows are dealt.
        """
        dealt = {self._dealt(n) for n in names}
        if len(dealt) != 1 or None in dealt:
            return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*[f"{self.root}/{n}" for n in names])
        buckets = dealt.pop()
        table = f"opened_{hashlib.md5(f'{self.root}:{names}'.encode()).hexdigest()}"
        if not self.spark.catalog.tableExists(table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(
                f"""CREATE TABLE {table} ({columns}, _part STRING) USING parquet PARTITIONED BY (_part)
                CLUSTERED BY ({buckets.key}) SORTED BY ({buckets.key}) INTO {buckets.count} BUCKETS LOCATION '{self.root}'"""
            )
            parts = " ".join(f"PARTITION (_part = '{n}') LOCATION '{self.root}/{n}'" for n in names)
            self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
        return self.spark.table(table).drop("_part")

    def read(self) -> DataFrame:
        version = self.version()
        if not version:
            return self.spark.createDataFrame([], self.schema)
        return self._open([f"v={version}"], self.schema)

    def write(self, df: DataFrame) -> int:
        number = self._claim()
        self._store(with_schema(df, self.schema), f"v={number}")
        return number

    def expire(self, keep: int = 1) -> None:
        """Delete all but the newest ``keep`` committed versions, and the merges that
        the oldest of these holds. Readers of what goes must have finished."""
        kept = self._numbers("v")[-max(keep, 1) :]
        if kept:
            self._before_expiry(kept[0])
        for kind in ("v", "m", "_claim") if kept else ():
            for number in self._numbers(kind, ""):
                if number < kept[0]:
                    self._fs().delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}={number}"), True)


    def _before_expiry(self, first: int) -> None:
        """What has to be noted before directories below a number go."""


class MergedTable(VersionedTable):
    """A table that takes touch-or-insert merges without being rewritten.

    A merge writes one directory ``m=<n>``: the rows it adds, and for rows that
    exist their keys and the time of the touch. Reading combines them with the
    newest version below; ``compact`` writes the combination as a version, sorted
    by key, or in its buckets. Versions and merges are numbered in one sequence and count once they
    are committed. Merges of one table follow one another: of two at the same time
    neither would see the other's rows.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: list[str], buckets: Buckets = None):
        super().__init__(spark, root, schema, buckets)
        self.keys = keys
        self.merge_schema = T.StructType(
            [*schema.fields, T.StructField("_new", T.BooleanType()), T.StructField("_merge", T.LongType())]
        )

    def merges(self) -> DataFrame | None:
        """Rows of the merges since the newest version, None without any."""
        version = self.version()
        names = [f"m={n}" for n in self._numbers("m") if n > version]
        return self._open(names, self.merge_schema) if names else None

    def _rows(self) -> DataFrame:
        """All rows as they were added, with the times of then."""
        version = self.version()
        names = [f"v={version}"] * bool(version) + [f"m={n}" for n in self._numbers("m") if n > version]
        if not names:
            return self.spark.createDataFrame([], self.schema)
        # Rows of a version have no merge.
        return self._open(names, self.merge_schema).where(F.coalesce("_new", F.lit(True))).select(*self.schema.names)

    def read(self, touched: bool = True) -> DataFrame:
        """All rows. Readers that need no time of the last update may do without it
        (``touched=False``): then the column is absent and no touched key is joined."""
        merges, rows = self.merges(), self._rows()
        if not touched:
            return rows.drop(UPDATED)
        if merges is None:
            return rows
        # One narrow row per touched key; small ones are broadcast by measured size.
        touched = merges.where("NOT _new")
        if self._merge_count() == 1:  # a merge has one row per key
            touched = touched.select(*self.keys, F.col(UPDATED).alias("_touched"))
        else:
            touched = touched.groupBy(*self.keys).agg(F.max_by(UPDATED, "_merge").alias("_touched"))
        joined = join_same(rows, touched, self.keys, "left")
        return joined.withColumn(UPDATED, F.coalesce("_touched", UPDATED)).select(*rows.columns)

    def _merged(self, feed: str, batch: int) -> bool:
        """Whether a batch of a feed is in the table: its merge is committed, or a mark
        says so. A writer that died leaves its number with nothing committed."""
        if self._merged_mark(feed, batch):
            return True
        tried = self._numbers(f"_batch={feed}={batch}", "")
        return bool(set(tried) & set(self._numbers("m")))

    def _before_expiry(self, first: int) -> None:
        """A batch whose writer died between commit and mark is marked now; what was
        tried under the numbers that go is forgotten."""
        committed = set(self._numbers("m"))
        for status in self._fs().globStatus(self._path(f"{self.root}/_batch=*")) or []:
            _, feed, batch, number = status.getPath().getName().split("=")
            if int(number) < first:
                if int(number) in committed and not self._merged_mark(feed, int(batch)):
                    self._note_done(feed, int(batch))
                self._fs().delete(status.getPath(), False)

    def _merged_mark(self, feed: str, batch: int) -> bool:
        done = self._numbers(f"_done={feed}", "")
        return bool(done) and batch <= done[-1]

    def _note_done(self, feed: str, batch: int) -> None:
        """Mark a batch; batches of a feed come in order, so the newest mark will do."""
        self._fs().createNewFile(self._path(f"{self.root}/_done={feed}={batch}"))
        for older in self._numbers(f"_done={feed}", ""):
            if older < batch:
                self._fs().delete(self._path(f"{self.root}/_done={feed}={older}"), False)

    def _merge_count(self) -> int:
        version = self.version()
        return sum(n > version for n in self._numbers("m"))

    def merge(self, source: DataFrame, now: Column, batch: tuple[str, int] = None, whole: bool = False) -> dict:
        """Touch the rows whose key ``source`` has, add its others; NULL is a key
        too, and one row per key counts. Returns how many keys were staged, updated
        and inserted, as the job that writes them counts them.

        Of the table only the keys are read, against the small side of a semi join,
        and only the batch is written. For a batch about as large as the table
        (``whole``) both are grouped together instead: the batch is then shuffled once
        and not written in between, but all keys of the table are shuffled.

        ``batch`` (feed, number) merges a numbered batch once: handed over again, it
        leaves the table as it is and returns zeros. What it will be is noted with
        the number of the merge before that is written, and counts with its commit.
        """
        if batch is not None and self._merged(*batch):
            self._note_done(*batch)
            return {"staged": 0, "updated": 0, "inserted": 0}
        number = self._claim()
        if batch is not None:
            feed, known = batch
            self._fs().createNewFile(self._path(f"{self.root}/_batch={feed}={known}={number}"))
        counts = self._merge(source, now, number, whole)
        if batch is not None:
            self._note_done(*batch)
        return counts

    def _merge(self, source: DataFrame, now: Column, number: int, whole: bool) -> dict:
        old = self._rows().select(*self.keys)
        if whole:
            marked = one_per_key_beside(source, old, self.keys, "_known")
            new = ~F.col("_known")
        else:
            batch = materialize(one_per_key(source, self.keys), "batch")
            known = join_same(old, batch.select(*self.keys), self.keys, "left_semi").distinct()
            marked = join_same(batch, known.withColumn("_known", F.lit(True)), self.keys, "left")
            new = F.col("_known").isNull()
        fields = {
            f.name: F.when(new, F.col(f.name) if f.name in source.columns else F.lit(None)).cast(f.dataType)
            for f in self.schema.fields
        }
        fields.update({k: F.col(k).cast(self.schema[k].dataType) for k in self.keys})
        fields.update({CREATED: F.when(new, now), UPDATED: now, "_new": new, "_merge": F.lit(number).cast("long")})
        total, added = F.count(F.lit(1)), F.count_if("_new")
        counts = {"staged": total, "updated": total - added, "inserted": added}
        return self._store(marked.select(*[c.alias(n) for n, c in fields.items()]), f"m={number}", counts)

    def compact(self, keep: int = None) -> int:
        """Write all merges into a new version; with ``keep`` expire older ones."""
        merges = self.merges()
        if merges is None:
            return self.version()
        rows = self.read()
        ordered = rows if self.buckets else rows.repartitionByRange(*self.keys).sortWithinPartitions(*self.keys)
        version = self.write(ordered)
        if keep:
            self.expire(keep)
        return version


def base_table(spark: SparkSession, lake: str, name: str) -> MergedTable:
    """A base table of a lake. Where ``paddock.buckets`` is set, tables that meet on a
    key are stored in so many buckets of it, and their joins move no row. A table
    written before stays as it is and is dealt anew by ``compact``."""
    count = int(spark.conf.get("paddock.buckets", "0"))
    key = shapes.BUCKETED_BY.get(name) if count else None
    return MergedTable(spark, f"{lake}/{name}", shapes.BASE_TABLES[name], shapes.KEYS[name], Buckets(key, count) if key else None)


def append_history(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Append run rows to a history table; absent columns are stored as NULL."""
    with_schema(df, schema).write.mode("append").parquet(path)


def read_history(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def write_by_date(df: DataFrame, path: str, at: str, mode: str = "overwrite") -> None:
    """Partition by the calendar date of ``at``. With ``mode="replace"`` only the dates
    that ``df`` has are replaced, and the files of all others stay untouched.

    Rows are spread over date and a hash of the row first: few files per date,
    and a date that holds most rows is still written by many tasks.
    """
    dated = df.withColumn("dt", F.to_date(at))
    # The range shuffle orders by date and cuts a large date into several tasks.
    spread = dated.repartitionByRange(F.col("dt"), F.xxhash64(*df.columns))
    writer = spread.write.mode("overwrite" if mode == "replace" else mode).partitionBy("dt")
    if mode == "replace":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def read_by_date(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    dated = T.StructType([*schema.fields, T.StructField("dt", T.DateType())])
    return spark.read.schema(dated).parquet(path)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Save for shuffle-free joins on ``key``.

    Starts and races bucketed alike by ``race_id`` make the join under every
    point-in-time feature a local merge of two sorted scans.
    """
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )
