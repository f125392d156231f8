"""Validation checks over the first feature version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paddock.functions import vocab as V
from paddock.plans.first_version import race_features_v1
from paddock.schema import RacingTables

REST_ORDER = [label for _, label in V.REST_BUCKETS]


def counts_by(tables: RacingTables, column: str) -> DataFrame:
    """Rows per value of a categorical feature, largest first."""
    per_value = race_features_v1(tables, [column]).groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))
    return per_value.orderBy(F.col("cnt").desc(), column)


def finish_places(tables: RacingTables) -> DataFrame:
    return counts_by(tables, "finish_place").orderBy("finish_place")


def temperature_range(tables: RacingTables) -> DataFrame:
    return race_features_v1(tables, ["temp_c"]).agg(
        F.min("temp_c").alias("min_temp"),
        F.max("temp_c").alias("max_temp"),
        F.count_if(F.col("temp_c").isNull()).alias("null_clamped"),
    )


def weather_totals(tables: RacingTables) -> DataFrame:
    flags = list(V.WEATHER_FLAGS)
    return race_features_v1(tables, flags).agg(
        *[F.sum(c).alias(c.removeprefix("is_") + "_cnt") for c in flags]
    )


def largest_campaigns(tables: RacingTables, k: int = 10) -> DataFrame:
    """The ``k`` largest yearly start counts and how many starters have them."""
    per_count = (
        race_features_v1(tables, ["horse_race_count"])
        .groupBy("horse_race_count")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    return per_count.orderBy(F.col("horse_race_count").desc()).limit(k)


def rest_distribution(tables: RacingTables) -> DataFrame:
    """Distinct horses per rest bucket, shortest rest first."""
    rank = F.array_position(F.array(*[F.lit(x) for x in REST_ORDER]), F.col("rest_bucket"))
    rank = F.when(rank > 0, rank).otherwise(len(REST_ORDER) + 1)
    return (
        race_features_v1(tables, ["horse_id", "rest_bucket"])
        .groupBy("rest_bucket")
        .agg(F.countDistinct("horse_id").alias("distinct_horses"))
        .orderBy(rank)
    )


def form_means(tables: RacingTables) -> DataFrame:
    form = race_features_v1(tables, ["win_rate_last_2", "win_rate_last_7"])
    return form.where(F.col("win_rate_last_7").isNotNull()).agg(
        F.avg("win_rate_last_2").alias("avg_win2_for_7starters"),
        F.avg("win_rate_last_7").alias("avg_win7"),
    )


ENTITIES = {"jockey": "j", "trainer": "t", "breeder": "b"}


def entity_count_range(tables: RacingTables) -> DataFrame:
    names = [f"{e}_race_count" for e in ENTITIES]
    bounds = [
        fn(c).alias(f"{label}_{ENTITIES[c.split('_')[0]]}c")
        for c in names
        for label, fn in (("min", F.min), ("max", F.max))
    ]
    return race_features_v1(tables, names).agg(*bounds)


def entity_rate_means(tables: RacingTables) -> DataFrame:
    return race_features_v1(tables, [f"{e}_win_pct" for e in ENTITIES]).agg(
        *[F.avg(f"{e}_win_pct").alias(f"avg_{short}w") for e, short in ENTITIES.items()]
    )


def specialty_means(tables: RacingTables) -> DataFrame:
    names = {
        "win_pct_1600": "avg_w1600",
        "win_pct_2000": "avg_w2000",
        "win_pct_delta_rain": "avg_rain_delta",
        "avg_place_delta_temp": "avg_temp_delta",
    }
    return race_features_v1(tables, list(names)).agg(*[F.avg(c).alias(a) for c, a in names.items()])


# ---- all checks at once -----------------------------------------------------
GROUPED = """finish_place distance_bucket temp_bucket track_surface_cat prize_amount_bucket
    horse_race_count rest_bucket""".split()


def _totals() -> dict[str, dict]:
    """The aggregates over all rows, by check and name."""
    flags = list(V.WEATHER_FLAGS)
    started = F.col("win_rate_last_7").isNotNull()
    return {
        "temperature_range": {"min_temp": F.min("temp_c"), "max_temp": F.max("temp_c"), "null_clamped": F.count_if(F.col("temp_c").isNull())},
        "weather_totals": {c.removeprefix("is_") + "_cnt": F.sum(c) for c in flags},
        "form_means": {"avg_win2_for_7starters": F.avg(F.when(started, F.col("win_rate_last_2"))), "avg_win7": F.avg("win_rate_last_7")},
        "entity_count_range": {f"{label}_{short}c": fn(f"{e}_race_count") for e, short in ENTITIES.items() for label, fn in (("min", F.min), ("max", F.max))},
        "entity_rate_means": {f"avg_{short}w": F.avg(f"{e}_win_pct") for e, short in ENTITIES.items()},
        "specialty_means": {
            "avg_w1600": F.avg("win_pct_1600"), "avg_w2000": F.avg("win_pct_2000"), "avg_rain_delta": F.avg("win_pct_delta_rain"),
            "avg_temp_delta": F.avg("avg_place_delta_temp"),
        },
    }


def all_checks(tables: RacingTables, k: int = 10) -> DataFrame:
    """All checks as rows (check, label, measure, value), from one pass over the
    features: a grouping set for each column that is counted by its values, and one more
    for the totals of the others. ``label`` is the value, null for unknown ones and for
    totals. All are combined before the shuffle, so no value's rows meet in one task. Only
    the set whose horses are told apart has a group for each horse and value.
    """
    totals = _totals()
    flags, entities = list(V.WEATHER_FLAGS), [f"{e}_{what}" for e in ENTITIES for what in ("race_count", "win_pct")]
    form = ["win_rate_last_2", "win_rate_last_7", "win_pct_1600", "win_pct_2000", "win_pct_delta_rain", "avg_place_delta_temp"]
    rows = race_features_v1(tables, ["horse_id", *GROUPED, "temp_c", *flags, *form, *entities])
    measures = {f"{check}:{name}": c for check, named in totals.items() for name, c in named.items()}
    names = [*GROUPED, "horse_id"]
    # The bits of the columns that are not grouped by are set.
    bit = {c: 1 << i for i, c in enumerate(reversed(names))}
    every = sum(bit.values())
    of = {c: every - bit[c] - (bit["horse_id"] if c == "rest_bucket" else 0) for c in GROUPED}
    sets = [[F.col(c), F.col("horse_id")] if c == "rest_bucket" else [F.col(c)] for c in GROUPED] + [[]]
    parts = rows.groupingSets(sets, *[F.col(c) for c in names]).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_cnt"), *[c.cast("double").alias(name) for name, c in measures.items()]
    )
    # Of the totals there is one row, so the greatest is that.
    grouped = parts.groupBy("_set", *GROUPED).agg(
        F.sum("_cnt").alias("_cnt"), F.count("horse_id").alias("_horses"), *[F.max(name).alias(name) for name in measures]
    )
    described = []
    for column in GROUPED:
        value, measure = (F.col("_horses"), "distinct_horses") if column == "rest_bucket" else (F.col("_cnt"), "cnt")
        row = F.struct(F.lit(column).alias("check"), F.col(column).cast("string").alias("label"), F.lit(measure).alias("measure"), value.cast("double").alias("value"))
        described.append(F.when(F.col("_set") == of[column], F.array(row)))
    whole = [
        F.struct(F.lit(check).alias("check"), F.lit(None).cast("string").alias("label"), F.lit(name).alias("measure"), F.col(f"{check}:{name}").alias("value"))
        for check, named in totals.items()
        for name in named
    ]
    described.append(F.when(F.col("_set") == every, F.array(*whole)))
    # Of the yearly start counts the largest; there are few of them.
    place = F.row_number().over(W.partitionBy("_set").orderBy(F.col("horse_race_count").desc_nulls_last()))
    wanted = (F.col("_set") != of["horse_race_count"]) | (F.col("_place") <= k)
    return grouped.withColumn("_place", place).where(wanted).select(F.inline(F.coalesce(*described)))
