"""One feed end to end: merge shards, clean the master, ingest the result."""

from __future__ import annotations

from pyspark.sql import SparkSession

from paddock.plans.day_counters import DayCounters
from paddock.plans.ingest import clean_masters, ingest_folder
from paddock.sources import files


def run_feed(spark: SparkSession, landing: str, lake: str, prefix: str, stamp: str, counters: DayCounters = None, page: int = files.PAGE) -> dict:
    """Run the stages in order. Every stage may be repeated after a failure, with
    the same stamp or another: shards are merged once, every finished master that
    is not cleaned is, and every cleaned one is ingested once. A backlog of over ``page``
    shards becomes several masters."""
    folder, merged, masters = f"{landing}/{prefix}", 0, 0
    ledger = f"{lake}/merged_shards/{prefix.rstrip('/')}"
    while True:
        name = stamp if not masters else f"{stamp}_{masters}"
        taken = files.merge_shards(spark, folder, f"{landing}/{files.master_name(prefix, name)}", ledger=ledger, page=page)
        merged, masters = merged + taken, masters + 1
        if taken < page:
            break
    clean = clean_masters(spark, folder.rstrip("/"))
    return {"merged": merged, "clean": clean, "ingest": ingest_folder(spark, landing, lake, prefix, counters, page)}
