"""Race-level and starter-level views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.functions import scalars as S
from paddock.functions import vocab as V
from paddock.operators.ordered import ROWS_PER_TASK, percentile_per_key
from paddock.schema import RacingTables


def surface_flags():
    return [S.flag(F.col("track_type") == label).alias(f"surface_{name}") for label, name in V.SURFACES.items()]


# The few RACES columns from which all static features derive.
STATIC_SOURCES = """track_distance_m temperature_c weather race_style race_group category_breed
    country_code city_name track_type""".split()


def static_columns(breed_prefix: str = "", poland=V.POLAND_CODES) -> list[Column]:
    """Static race features over ``STATIC_SOURCES``."""
    metres = F.col("track_distance_m")
    breeds = {label: breed_prefix + name for label, name in V.BREEDS.items()}
    return [
        metres.alias("distance_m"),
        *S.band_flags(metres),
        F.col("temperature_c"),
        *S.weather_flags(F.col("weather")),
        S.style_ease_score(F.col("race_style")).alias("style_ease_score"),
        *S.one_hot(F.col("race_group"), V.RACE_GROUPS),
        *S.one_hot(F.col("category_breed"), breeds),
        S.flag(F.col("country_code").isin(poland)).alias("country_PL"),
        S.flag(F.col("city_name") == V.WARSAW).alias("city_Warsaw"),
        *surface_flags(),
    ]


def races_base(tables: RacingTables, poland=V.POLAND_CODES) -> DataFrame:
    """Static race features; a projection of RACES."""
    return tables.races.select("race_id", *static_columns(poland=poland))


def races_payouts(tables: RacingTables) -> DataFrame:
    text = F.col("payments")
    return tables.races.select(
        "race_id", *[S.payout(text, code).alias(f"payout_{code.lower()}") for code in V.PAYOUT_CODES]
    )


def field_size(tables: RacingTables) -> DataFrame:
    """Starters of every race, scratched ones included, one row per race."""
    return tables.race_records.groupBy("race_id").agg(F.count(F.lit(1)).alias("field_size"))


def race_context(tables: RacingTables, rows_per_task: int | None = ROWS_PER_TASK) -> DataFrame:
    """Per race: starters (scratched ones included) and the median weight."""
    return percentile_per_key(
        tables.race_records.select("race_id", "jockey_weight_kg"),
        ["race_id"],
        "jockey_weight_kg",
        0.5,
        "median_jockey_weight_kg",
        {"field_size": F.count(F.lit(1))},
        rows_per_task,
    )


def records_context(tables: RacingTables, rows_per_task: int | None = ROWS_PER_TASK) -> DataFrame:
    """Field size and weight relative to the field, per starter.

    Computed per race and joined back: a window over the race would put a hot
    race into one task.
    """
    diff = F.col("jockey_weight_kg") - F.col("median_jockey_weight_kg")
    return (
        tables.race_records.select("race_id", "horse_id", "start_order", "jockey_weight_kg")
        .join(race_context(tables, rows_per_task), "race_id", "left")
        .select(
            "race_id",
            "horse_id",
            "field_size",
            "start_order",
            "jockey_weight_kg",
            "median_jockey_weight_kg",
            diff.alias("weight_diff"),
        )
    )


def records_outcomes(tables: RacingTables) -> DataFrame:
    place = F.col("finish_place")
    return tables.race_records.select("race_id", "horse_id", "finish_place", *S.outcome_flags(place))
