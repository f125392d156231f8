"""Per-starter feature sets: training rows and upcoming starters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.functions import scalars as S
from paddock.functions import vocab as V
from paddock.operators.ordered import ROWS_PER_TASK
from paddock.plans.horses import SharedCounts, horse_features, shared_counts
from paddock.plans.people import breeders, jockeys, trainers
from paddock.plans.races import STATIC_SOURCES, race_context, static_columns
from paddock.plans.starts import asof_starts
from paddock.schema import RacingTables
from paddock.session import lookup


def _filled_recent(person: str):
    """Recent win rates with 0 for people without recent starts."""
    names = [f"{person}_win_pct_last_{days}d" for days in (30, 60)]
    return {n: F.coalesce(F.col(n), F.lit(0.0)) for n in names}


def race_features(
    tables: RacingTables,
    as_of,
    starts: DataFrame = None,
    rows_per_task: int = ROWS_PER_TASK,
    common: SharedCounts = None,
) -> DataFrame:
    """One row per starter that ran from a known gate to a known place.

    Entity features use the one cut-off ``as_of`` for all races. Horse and
    breeder features meet at horse grain first, so the starters are shuffled
    once per key: horse, race, jockey, trainer (the last two are counted first and
    broadcast when their size allows it). Flags are derived after the
    joins from the few columns behind them, which keeps shuffled rows narrow.
    """
    starts = asof_starts(tables, as_of) if starts is None else starts
    common = common or shared_counts(tables, as_of, starts)
    coded = ["horse_sex", "breed"]
    horse = horse_features(tables, as_of, keep=["breeder_id", *coded], common=common).select(
        "horse_id", "breeder_id", *coded, F.col("age_years").alias("horse_age_years")
    )
    bred = breeders(tables, as_of, common=common)
    horse = horse.join(bred, "breeder_id", "left").drop("breeder_id")
    static = tables.races.select("race_id", *STATIC_SOURCES)
    race = race_context(tables, rows_per_task).join(static, "race_id", "left")
    ran = tables.race_records.where(
        F.col("start_order").isNotNull() & F.col("finish_place").isNotNull()
    ).select(
        "race_id", "horse_id", "jockey_id", "trainer_id", "start_order", "jockey_weight_kg",
        "finish_place",
    )
    rider = lookup(jockeys(tables, as_of, starts), "jockeys")
    coach = lookup(trainers(tables, as_of, starts), "trainers")
    wide = (
        ran.join(horse, "horse_id")
        .join(race, "race_id", "left")
        .join(rider, "jockey_id", "left")
        .join(coach, "trainer_id", "left")
    )
    filled = {**_filled_recent("jockey"), **_filled_recent("trainer")}

    def features(df: DataFrame, key: str) -> list:
        return [filled.get(c, F.col(c)).alias(c) for c in df.columns if c != key]

    return wide.select(
        "race_id",
        "horse_id",
        "jockey_id",
        "trainer_id",
        "horse_age_years",
        *S.one_hot(F.col("horse_sex"), V.SEXES),
        *S.one_hot(F.col("breed"), V.BREEDS),
        *static_columns(breed_prefix="race_"),
        "field_size",
        "start_order",
        "jockey_weight_kg",
        (F.col("jockey_weight_kg") - F.col("median_jockey_weight_kg")).alias("weight_diff"),
        "finish_place",
        *S.outcome_flags(F.col("finish_place")),
        *features(rider, "jockey_id"),
        *features(coach, "trainer_id"),
        *features(bred, "breeder_id"),
    )


def assemble_new_races(
    tables: RacingTables,
    upcoming: DataFrame,
    as_of,
    starts: DataFrame = None,
    common: SharedCounts = None,
) -> DataFrame:
    """Upcoming starters with the features of their horse, breeder and people.

    Unknown horses and people keep their row with NULL features. The rate of the
    horse's own trainer is ``horse_trainer_win_pct``, to keep it apart from that
    of the trainer entered.
    """
    starts = asof_starts(tables, as_of) if starts is None else starts
    common = common or shared_counts(tables, as_of, starts)
    horse = (
        horse_features(tables, as_of, keep=["breeder_id"], common=common)
        .withColumn("horse_age_years", F.col("age_years"))
        .withColumnRenamed("trainer_win_pct", "horse_trainer_win_pct")
    )
    horse = horse.join(breeders(tables, as_of, common=common), "breeder_id", "left").drop("breeder_id")
    return (
        upcoming.join(horse, "horse_id", "left")
        .join(jockeys(tables, as_of, starts), "jockey_id", "left")
        .join(trainers(tables, as_of, starts), "trainer_id", "left")
    )
