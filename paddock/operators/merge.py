"""Touch-or-insert merge over plain DataFrames, and its row counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.operators.ordered import join_same

CREATED, UPDATED = "created_date", "last_updated_date"


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keep one row per key (NULL is a key too), the same one on every run.

    The smallest row wins. ``min`` over a struct combines before the shuffle,
    so many copies of one key cost one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    kept = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return kept.select(*keys, "_row.*").select(*df.columns)


def one_per_key_beside(df: DataFrame, old: DataFrame, keys: list[str], known: str) -> DataFrame:
    """``one_per_key`` with a flag ``known``: whether ``old`` has the key as well.

    Rows and keys are grouped together, so each side is shuffled once and NULL is a
    key without a join that says so.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*rest, F.lit(True).alias("_staged"))
    staged = df.select(*keys, row.alias("_row"), F.lit(False).alias(known))
    both = staged.unionByName(old.select(*keys, F.lit(True).alias(known)), allowMissingColumns=True)
    kept = both.groupBy(*keys).agg(F.min("_row").alias("_row"), F.bool_or(known).alias(known))
    kept = kept.where(F.col("_row").isNotNull())
    return kept.select(*keys, "_row.*", known).select(*df.columns, known)


def merge_touch_or_insert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    now: Column,
    update: list[str] = (),
    audit: bool = True,
) -> DataFrame:
    """New content of ``target`` after merging ``source`` on ``keys``.

    A matched row keeps its values and only gets a new update time; an
    unmatched source row is inserted. ``update`` names columns to overwrite on
    a match. Keys compare null-safe, and the source is reduced to one row per
    key, so repeating a merge never adds rows.
    """
    source = one_per_key(source, keys)
    staged = source.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in update], F.lit(True).alias("_hit")
    )
    joined = join_same(target, staged, keys, "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    fresh = {c: F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in update}
    if audit:
        fresh[UPDATED] = F.when(hit, now).otherwise(F.col(UPDATED))
    kept = joined.select(*[fresh.get(c, F.col(c)).alias(c) for c in target.columns])

    # Only keys are read for the insert side, and of those only the staged ones.
    old = target.select(*keys)
    names = source.select(*keys)
    known = join_same(old, names, keys, "left_semi")
    added = join_same(source, known, keys, "left_anti")
    stamps = {CREATED: now, UPDATED: now} if audit else {}
    have = set(source.columns)
    types = {f.name: f.dataType for f in target.schema.fields}
    added = added.select(
        *[
            stamps.get(c, F.col(c) if c in have else F.lit(None)).cast(types[c]).alias(c)
            for c in target.columns
        ]
    )
    return kept.unionByName(added)


def merge_counts(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """One row: distinct staged keys, how many exist already, how many are new."""
    staged = source.select(*keys).distinct()
    old = target.select(*keys).distinct().withColumn("_old", F.lit(1))
    joined = join_same(staged, old, keys, "left")
    known = F.count("_old")
    total = F.count(F.lit(1))
    return joined.agg(
        total.alias("staged"), known.alias("updated"), (total - known).alias("inserted")
    )
