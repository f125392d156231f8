"""Incremental pick-up of cleaned files with a streaming checkpoint.

The alternative to the watermark table: the file source remembers which files
it has read, so each is handled once even when two share a time stamp.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.plans.day_counters import DayCounters
from paddock.plans.ingest import FEEDS, merge_batch
from paddock.session import materialize
from paddock.sources.ndjson import CORRUPT, BadRecordBudgetExceeded


def cleaned_stream(
    spark: SparkSession, landing: str, schema: T.StructType, files_per_batch: int = None
) -> DataFrame:
    """Rows of cleaned files, and of cleaned directories that a job wrote."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(f"{landing.rstrip('/')}/*CLEANED_*.ndjson")


def ingest_available(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    checkpoint: str,
    sink: Callable[[DataFrame, int], None],
    files_per_batch: int = None,
) -> None:
    """Hand all files not seen before to ``sink(batch, batch_id)``, then stop.

    A batch may be handed over again after a failure, so the sink should be
    idempotent, as the touch-or-insert merge is.
    """
    stream = cleaned_stream(spark, landing, schema, files_per_batch)
    query = (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest_stream(
    spark: SparkSession,
    landing: str,
    lake: str,
    prefix: str,
    checkpoint: str,
    files_per_batch: int = None,
    counters: DayCounters = None,
) -> list[dict]:
    """Merge all cleaned files not seen before into the base tables, batch by batch;
    returns the merge counts of each batch.

    The checkpoint knows which files were read, and each merge notes the number of
    its batch with its commit, so rows are touched and added once even if a batch is
    handed over again. Malformed rows over the budget of the prefix, in a batch, stop
    the stream before that batch is merged.
    """
    shape, _, budget = FEEDS[prefix]
    marked = T.StructType([*shape.fields, T.StructField(CORRUPT, T.StringType())])
    counts = []

    def sink(batch: DataFrame, number: int) -> None:
        # Stored once: the budget and every table read it.
        staged = materialize(batch.withColumn("_bad", F.col(CORRUPT).isNotNull()).drop(CORRUPT), "staged")
        bad = staged.where("_bad").limit(budget + 1).count()
        if bad > budget:
            raise BadRecordBudgetExceeded(f"over {budget} malformed records in batch {number} of {prefix}")
        counts.append(merge_batch(spark, lake, prefix, staged.where("NOT _bad").drop("_bad"), number, counters))

    ingest_available(spark, f"{landing}/{prefix}", marked, checkpoint, sink, files_per_batch)
    return counts
