"""Ordered work per key that stays parallel when one key holds most rows.

A Spark window sends every row of a key to one task. That is the right plan
while keys are small, and it is the plan used here for them. Keys above
``rows_per_task`` are taken out, range-partitioned by (key, order) into chunks
and written to shared scratch space; each chunk is then windowed on its own,
after the few rows it needs from earlier chunks have been put in front of it.
The results equal those of one plain window per key.

Finding the hot keys is a Spark job that runs while the query is built. Where it is
known that there are none, ``rows_per_task=None`` skips it and the plan stays lazy.

``order`` must be a total order within the key (include a unique tiebreak).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paddock.session import materialize

ROWS_PER_TASK = 4_000_000
CHUNK, GHOST = "_chunk", "_ghost"


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on equally named keys where NULL equals NULL; keeps the left keys."""
    renamed = right.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    joined = left.join(renamed, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_k_{k}" for k in keys])


def hot_keys(df: DataFrame, keys: list[str], rows_per_task: int) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows: at most rows / rows_per_task."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > rows_per_task)
    )


def split_hot(df: DataFrame, keys: list[str], rows_per_task: int | None, sized_by: DataFrame = None):
    """(light rows, hot rows, number of chunks), the last two empty without hot keys.

    Costs one counting pass over the key columns of ``sized_by``: a cheaper
    table with at least as many rows per key as ``df``, or ``df`` itself. Without
    ``rows_per_task`` nothing is counted: the caller knows that no key is hot.
    """
    if rows_per_task is None:
        return df, None, 0
    hot = hot_keys(df if sized_by is None else sized_by, keys, rows_per_task)
    if hot.isEmpty():
        return df, None, 0
    hot = materialize(hot, "hot-keys")
    rows = hot.agg(F.sum("_rows")).first()[0]
    chunks = -(-rows // rows_per_task) + 1
    names = hot.select(*keys)
    light = join_same(df, names, keys, "left_anti")
    heavy = join_same(df, names, keys, "left_semi")
    return light, heavy, chunks


def chunked(heavy: DataFrame, keys: list[str], order: list[str], chunks: int) -> DataFrame:
    """Contiguous runs of (key, order), numbered in order and fixed on storage."""
    ranged = heavy.repartitionByRange(chunks, *keys, *order)
    return materialize(ranged.withColumn(CHUNK, F.spark_partition_id()), "chunks")


def _ghosts(parts: DataFrame, keys, order, n: int, carry: list[str], pick: Column) -> DataFrame:
    """For every (key, chunk): copies of the last ``n`` picked rows before it.

    Works on at most ``n`` rows per (key, chunk), so its per-key windows are
    bounded by n times the number of chunks.
    """
    backwards = W.partitionBy(*keys, CHUNK).orderBy(*[F.col(c).desc() for c in order])
    columns = list(dict.fromkeys([*keys, *order, *carry]))
    tails = (
        parts.where(pick)
        .withColumn("_back", F.row_number().over(backwards))
        .where(F.col("_back") <= n)
        .select(*columns, F.col(CHUNK).alias("_from"))
        .withColumn("_want", F.row_number().over(W.partitionBy(*keys).orderBy("_from", *order)))
        .drop("_from")
    )
    before = W.partitionBy(*keys).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    wanted = (
        parts.groupBy(*keys, CHUNK)
        .agg(F.least(F.count_if(pick), F.lit(n)).alias("_own"))
        .withColumn("_seen", F.coalesce(F.sum("_own").over(before), F.lit(0)))
        .where(F.col("_seen") > 0)
        .select(
            *keys,
            CHUNK,
            F.explode(
                F.sequence(F.greatest(F.col("_seen") - (n - 1), F.lit(1)), F.col("_seen"))
            ).alias("_want"),
        )
    )
    found = join_same(wanted, tails, [*keys, "_want"], "inner")
    return found.select(*columns, CHUNK, F.lit(True).alias(GHOST))


def over_recent_rows(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    n: int,
    carry: list[str],
    features: Callable[[W], dict[str, Column]],
    pick: Column = None,
    rows_per_task: int | None = ROWS_PER_TASK,
    sized_by: DataFrame = None,
) -> DataFrame:
    """Add window columns that look back over at most ``n`` (picked) rows.

    ``features`` builds the columns from an ordered window; they may read only
    ``order`` and ``carry`` columns of earlier rows. With ``pick`` the look-back
    counts only rows that satisfy it (``last(x, ignorenulls=True)`` needs n=1).
    """
    light, heavy, chunks = split_hot(df, keys, rows_per_task, sized_by)
    plain = features(W.partitionBy(*keys).orderBy(*order))
    out = light.withColumns(plain)
    if heavy is None:
        return out
    parts = chunked(heavy, keys, order, chunks)
    pick = F.lit(True) if pick is None else pick
    ghosts = _ghosts(parts, keys, order, n, carry, pick)
    both = parts.withColumn(GHOST, F.lit(False)).unionByName(ghosts, allowMissingColumns=True)
    inside = features(W.partitionBy(*keys, CHUNK).orderBy(*order))
    done = both.withColumns(inside).where(~F.col(GHOST)).drop(GHOST, CHUNK)
    return out.unionByName(done.select(*out.columns))


def percentile_per_key(
    df: DataFrame,
    keys: list[str],
    value: str,
    q: float,
    name: str,
    totals: dict[str, Column] = None,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Exact, interpolated percentile of the non-NULL values of every key.

    ``totals`` are further aggregates over all rows of the key. Ordinary keys
    get everything from one grouped pass.
    """
    sums = [c.alias(n) for n, c in (totals or {}).items()]
    light, heavy, chunks = split_hot(df, keys, rows_per_task)
    out = light.groupBy(*keys).agg(F.percentile(value, F.lit(q)).alias(name), *sums)
    if heavy is None:
        return out
    known = heavy.where(F.col(value).isNotNull()).select(*keys, value)
    parts = chunked(known, keys, [value], chunks)
    # Equal values may fill one chunk, so ranks are taken over distinct values.
    counted = parts.groupBy(*keys, CHUNK, value).agg(F.count(F.lit(1)).alias("_n"))
    per_chunk = parts.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("_rows"))
    by_chunk = W.partitionBy(*keys).orderBy(CHUNK)
    whole = W.partitionBy(*keys)
    at = (F.col("_total") - 1) * q
    # Only the (at most two) chunks that hold the wanted ranks are looked into.
    wanted = (
        per_chunk.withColumn("_end", F.sum("_rows").over(by_chunk))
        .withColumn("_total", F.sum("_rows").over(whole))
        .withColumn("_start", F.col("_end") - F.col("_rows"))
        .withColumn("_lo", F.floor(at) + 1)
        .withColumn("_hi", F.ceil(at) + 1)
        .withColumn("_part", at - F.floor(at))
        .where((F.col("_start") < F.col("_hi")) & (F.col("_end") >= F.col("_lo")))
        .select(*keys, CHUNK, "_start", "_lo", "_hi", "_part")
    )
    by_value = W.partitionBy(*keys, CHUNK).orderBy(value)
    ranked = (
        join_same(counted, wanted, [*keys, CHUNK], "inner")
        .withColumn("_end", F.col("_start") + F.sum("_n").over(by_value))
        .withColumn("_first", F.col("_end") - F.col("_n") + 1)
    )

    def at_rank(rank: str) -> Column:
        return F.max(F.when(F.col(rank).between(F.col("_first"), F.col("_end")), F.col(value)))

    found = ranked.groupBy(*keys).agg(
        at_rank("_lo").alias("_a"), at_rank("_hi").alias("_b"), F.max("_part").alias("_part")
    )
    between = (1 - F.col("_part")) * F.col("_a") + F.col("_part") * F.col("_b")
    picked = found.select(
        *keys, F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(between).alias(name)
    )
    whole_key = heavy.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *sums).drop("_rows")
    return out.unionByName(join_same(whole_key, picked, keys, "left").select(*out.columns))
