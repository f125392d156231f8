"""Jockey, trainer and breeder features as of a date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.functions import scalars as S
from paddock.functions import vocab as V
from paddock.operators.rates import band_families, rates_by, share, surface_families
from paddock.plans.horses import SharedCounts, horses_career, shared_counts
from paddock.plans.starts import as_date, asof_starts
from paddock.schema import RacingTables


def within(days: int, as_of) -> Column:
    """Raced at most ``days`` before the cut-off."""
    return F.col("race_date") >= F.lit(as_date(as_of) - dt.timedelta(days=days))


def person_features(starts: DataFrame, as_of, person: str, bands: dict) -> DataFrame:
    """Totals, recent form and specialization of one kind of person.

    A single grouped aggregate yields all rates: a handful of counters per
    person, combined before the shuffle. Recent rates stay NULL without recent
    starts; specialization rates default to 0.
    """
    key = f"{person}_id"
    pct = f"{person}_win_pct"
    mine = starts.where(F.col(key).isNotNull())
    totals = {
        f"{person}_total_starts": F.count(F.lit(1)),
        f"{person}_total_wins": F.count_if(S.is_win()),
        pct: share(S.is_win()),
        f"{pct}_last_30d": share(S.is_win(), within(30, as_of)),
        f"{pct}_last_60d": share(S.is_win(), within(60, as_of)),
    }
    families = {
        **surface_families(f"{pct}_surface", F.col("track_type"), V.SURFACES),
        **band_families(f"{pct}_dist", F.col("track_distance_m"), bands),
    }
    return rates_by(mine, [key], totals, families, default=0.0)


def jockeys(tables: RacingTables, as_of, starts: DataFrame = None) -> DataFrame:
    starts = asof_starts(tables, as_of) if starts is None else starts
    return person_features(starts, as_of, "jockey", V.JOCKEY_BANDS)


def stable_size(tables: RacingTables) -> DataFrame:
    return tables.horses.groupBy("trainer_id").agg(
        F.countDistinct("horse_id").alias("trainer_active_horses")
    )


def trainers(tables: RacingTables, as_of, starts: DataFrame = None) -> DataFrame:
    starts = asof_starts(tables, as_of) if starts is None else starts
    people = person_features(starts, as_of, "trainer", V.RACE_BANDS)
    size = F.coalesce("trainer_active_horses", F.lit(0).cast("long"))
    return people.join(stable_size(tables), "trainer_id", "left").withColumn(
        "trainer_active_horses", size
    )


def breeders(
    tables: RacingTables, as_of, starts: DataFrame = None, common: SharedCounts = None
) -> DataFrame:
    """Progeny volume, success and last-year form per breeder.

    Starts are first counted per horse, so the breeder roll-up joins two
    horse-grain tables instead of every start.
    """
    common = common or shared_counts(tables, as_of, starts)
    form = common.form.select("horse_id", "starts_1yr", "wins_1yr")
    owned = tables.horses.where(F.col("breeder_id").isNotNull()).select("horse_id", "breeder_id")
    career = common.careers.select(
        "horse_id", "career_starts", "career_wins", "total_earnings", F.lit(1).alias("_ran")
    )
    progeny = owned.join(career, "horse_id", "left").join(form, "horse_id", "left")
    ran = F.col("_ran").isNotNull()
    starts1, wins1 = (F.coalesce(F.sum(c), F.lit(0).cast("long")) for c in ("starts_1yr", "wins_1yr"))
    return (
        progeny.groupBy("breeder_id")
        .agg(
            F.count_if(ran).alias("breeder_progeny_count"),
            F.sum("career_starts").alias("breeder_total_progeny_race_count"),
            F.sum("career_wins").alias("breeder_total_progeny_win_count"),
            F.avg(S.ratio(F.col("career_wins"), F.col("career_starts"))).alias("breeder_avg_win_pct"),
            F.avg("total_earnings").alias("breeder_avg_earnings"),
            starts1.alias("breeder_progeny_race_count_last_1yr"),
            wins1.alias("breeder_progeny_win_count_last_1yr"),
            F.coalesce(S.ratio(F.sum("wins_1yr"), F.sum("starts_1yr")), F.lit(0.0)).alias(
                "breeder_win_pct_progeny_last_1yr"
            ),
        )
        # A breeder is listed once one of its progeny has a career.
        .where(F.col("breeder_progeny_count") > 0)
    )


def breeder_progeny(tables: RacingTables, as_of) -> DataFrame:
    """Per breeder: horses with a career, their starts and their mean earnings."""
    owned = tables.horses.where(F.col("breeder_id").isNotNull()).select("horse_id", "breeder_id")
    return owned.join(horses_career(tables, as_of), "horse_id").groupBy("breeder_id").agg(
        F.count("horse_id").alias("progeny"),
        F.sum("career_starts").alias("starts"),
        F.avg("total_earnings").alias("avg_earnings"),
    )
