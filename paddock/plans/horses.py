"""Horse features as of a date."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.functions import scalars as S
from paddock.functions import vocab as V
from paddock.operators.rates import rates_by, starts_and_wins
from paddock.plans.starts import after, as_date, asof_starts, one_year_before
from paddock.schema import RacingTables
from paddock.session import materialize


def age_columns(birth_year: Column, as_of) -> list[Column]:
    age = F.lit(as_date(as_of).year).cast("long") - birth_year
    return [age.alias("age_years"), ((age < 0) | (age > 20)).alias("is_age_outlier")]


CODED = ["horse_sex", "breed", "color_name_pl"]


def onehot_columns() -> list[Column]:
    return [
        *S.one_hot(F.col("horse_sex"), V.SEXES),
        *S.one_hot(F.col("breed"), V.BREEDS),
        *S.one_hot(F.col("color_name_pl"), {c: f"color_{c}" for c in V.COLORS}),
    ]


def horses_base(tables: RacingTables, as_of) -> DataFrame:
    """Age and one-hot encodings; a projection of HORSES."""
    return tables.horses.select(
        "horse_id", *age_columns(F.col("birth_year"), as_of), *onehot_columns()
    )


# ---- careers ----------------------------------------------------------------
def career_sums(tables: RacingTables, as_of) -> DataFrame:
    """Career, last-three-years and current-year sums in one pass per horse.

    Amounts that hold a comma list do not parse and drop out of the sum. The
    current year is summed over its race types, one row per horse.
    """
    year = as_date(as_of).year
    races = F.col("race_count").try_cast("long")
    wins = F.col("race_won_count").try_cast("long")
    recent = F.col("race_year") >= year - 2
    current = F.col("race_year") == year
    return (
        tables.horse_careers.where(F.col("race_year") <= year)
        .groupBy("horse_id")
        .agg(
            F.sum(races).alias("career_starts"),
            F.sum(wins).alias("career_wins"),
            F.sum(S.single_amount(F.col("prize_amounts"))).alias("total_earnings"),
            F.sum(F.when(recent, races)).alias("_races3"),
            F.sum(F.when(recent, wins)).alias("_wins3"),
            F.sum(F.when(current, races)).alias("_races1"),
            F.sum(F.when(current, wins)).alias("_wins1"),
        )
    )


def _career_columns() -> list[Column]:
    starts = F.col("career_starts")
    return [
        starts,
        F.col("career_wins"),
        S.ratio(F.col("career_wins"), starts).alias("career_win_pct"),
        F.col("total_earnings"),
        S.ratio(F.col("total_earnings"), starts).alias("earnings_per_start"),
    ]


def horses_career(tables: RacingTables, as_of) -> DataFrame:
    return career_sums(tables, as_of).select("horse_id", *_career_columns())


def career_overview(careers: DataFrame) -> DataFrame:
    """Per horse: its career rows, how many of them have a single amount, starts,
    first and last year, and the mean of the wins."""
    return careers.groupBy("horse_id").agg(
        F.count(F.lit(1)).alias("rows_all"),
        F.count(S.single_amount(F.col("prize_amounts"))).alias("rows_priced"),
        F.sum("race_count").alias("starts"),
        F.min("race_year").alias("first_year"),
        F.max("race_year").alias("last_year"),
        F.avg("race_won_count").alias("avg_won"),
    )


# ---- form -------------------------------------------------------------------
def horse_form(starts: DataFrame, as_of) -> DataFrame:
    """Per horse: starts, wins, the last date, and the counts of the last year."""
    recent = after(F.col("race_date"), one_year_before(as_of))
    return rates_by(
        starts,
        ["horse_id"],
        {
            "starts": F.count(F.lit(1)),
            "wins": F.count_if(S.is_win()),
            "last_date": F.max("race_date"),
            "starts_1yr": F.count_if(recent),
            "wins_1yr": F.count_if(recent & S.is_win()),
        },
    )


@dataclass(frozen=True)
class SharedCounts:
    """What the features of horses, breeders and starters of one date have in
    common: ``form`` and ``careers`` per horse, ``trainers`` per trainer."""

    form: DataFrame
    trainers: DataFrame
    careers: DataFrame


def shared_counts(
    tables: RacingTables, as_of, starts: DataFrame = None, stored: tuple[str, ...] = ()
) -> SharedCounts:
    """Counts of horses and trainers from one pass over the starts.

    Starts are counted per (horse, trainer) and rolled up to each. ``stored`` names
    what is written to scratch storage because it has several readers: ``form``
    (with the pairs under it), so that records are read once, and ``careers``.
    """
    starts = asof_starts(tables, as_of) if starts is None else starts

    def keep(df: DataFrame, name: str) -> DataFrame:
        return materialize(df, name, True) if name in stored else df

    recent = after(F.col("race_date"), one_year_before(as_of))
    pairs = starts.groupBy("horse_id", "trainer_id").agg(
        F.count(F.lit(1)).alias("starts"),
        F.count_if(S.is_win()).alias("wins"),
        F.max("race_date").alias("last_date"),
        F.count_if(recent).alias("starts_1yr"),
        F.count_if(recent & S.is_win()).alias("wins_1yr"),
    )
    pairs = keep(pairs, "form")
    sums = [F.sum(c).alias(c) for c in ("starts", "wins", "starts_1yr", "wins_1yr")]
    form = pairs.groupBy("horse_id").agg(*sums, F.max("last_date").alias("last_date"))
    return SharedCounts(
        keep(form, "form"),
        pairs.groupBy("trainer_id").agg(*sums[:2]),
        keep(career_sums(tables, as_of), "careers"),
    )


def _recent_columns(as_of) -> list[Column]:
    def known(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0).cast("long"))

    pct3 = F.coalesce(S.ratio(F.col("_wins3"), F.col("_races3")), F.lit(0.0))
    pct1 = F.coalesce(S.ratio(F.col("_wins1"), F.col("_races1")), F.lit(0.0))
    days = F.datediff(F.lit(as_date(as_of)), F.to_date("last_date")).cast("long")
    return [
        known("_races3").alias("rolling_race_count_last_3yrs"),
        known("_wins3").alias("rolling_win_count_last_3yrs"),
        pct3.alias("rolling_win_pct_last_3yrs"),
        known("_races1").alias("race_count_current_year"),
        known("_wins1").alias("win_count_current_year"),
        pct1.alias("win_pct_current_year"),
        (pct1 - pct3).alias("current_vs_last3yrs_win_pct"),
        days.alias("days_since_last_race"),
    ]


def horses_recent(
    tables: RacingTables, as_of, starts: DataFrame = None, common: SharedCounts = None
) -> DataFrame:
    common = common or shared_counts(tables, as_of, starts)
    form = common.form.select("horse_id", "last_date")
    return (
        tables.horses.select("horse_id")
        .join(common.careers, "horse_id", "left")
        .join(form, "horse_id", "left")
        .select("horse_id", *_recent_columns(as_of))
    )


# ---- relatives and people ---------------------------------------------------
ROLES = {"sire": "father_id", "dam": "mother_id", "trainer": "trainer_id", "breeder": "breeder_id"}


def breeder_form(horses: DataFrame, form: DataFrame) -> DataFrame:
    """Breeder counts, rolled up from per-horse counts rather than from starts."""
    owned = horses.where(F.col("breeder_id").isNotNull()).select("horse_id", "breeder_id")
    return owned.join(form, "horse_id").groupBy("breeder_id").agg(
        F.sum("starts").alias("starts"), F.sum("wins").alias("wins")
    )


def _with_role(df: DataFrame, counts: DataFrame, role: str) -> DataFrame:
    named = counts.toDF("_id", f"{role}_starts", f"{role}_wins")
    return df.join(named, F.col(ROLES[role]) == F.col("_id"), "left").drop("_id")


def _role_columns() -> list[Column]:
    out = []
    for role in ROLES:
        starts, wins = F.col(f"{role}_starts"), F.col(f"{role}_wins")
        out += [
            F.coalesce(starts, F.lit(0).cast("long")).alias(f"{role}_starts"),
            F.coalesce(wins, F.lit(0).cast("long")).alias(f"{role}_wins"),
            F.coalesce(S.ratio(wins, starts), F.lit(0.0)).alias(f"{role}_win_pct"),
        ]
    return out


def with_roles(horses: DataFrame, common: SharedCounts) -> DataFrame:
    """Attach raw counts of sire, dam, trainer and breeder to every horse.

    Sire and dam look up the same per-horse counts, so restricting those to
    parents first would only add a join. All lookups happen at horse grain.
    """
    own = common.form.select("horse_id", "starts", "wins")
    people = common.trainers.where(F.col("trainer_id").isNotNull())
    out = _with_role(horses, own, "sire")
    out = _with_role(out, own, "dam")
    out = _with_role(out, people, "trainer")
    return _with_role(out, breeder_form(horses, own), "breeder")


def horses_perf(
    tables: RacingTables, as_of, starts: DataFrame = None, common: SharedCounts = None
) -> DataFrame:
    common = common or shared_counts(tables, as_of, starts)
    keys = tables.horses.select("horse_id", *ROLES.values())
    return with_roles(keys, common).select("horse_id", *_role_columns())


def parent_runs(tables: RacingTables, as_of, parent: str = "father_id") -> DataFrame:
    """Starts and wins of the horses that are a parent of another."""
    parents = tables.horses.select(F.col(parent).alias("horse_id")).where(F.col("horse_id").isNotNull()).distinct()
    # Counting first leaves one row per horse for the semi join.
    own = starts_and_wins(asof_starts(tables, as_of), "horse_id", "", pct=False)
    return own.join(parents, "horse_id", "left_semi")


def sire_progeny(tables: RacingTables, parent: str = "father_id") -> DataFrame:
    """Starts and wins of all progeny of a parent (a self-reference of HORSES)."""
    own = starts_and_wins(tables.race_records, "horse_id", "", pct=False)
    kin = tables.horses.where(F.col(parent).isNotNull()).select("horse_id", parent)
    sums = kin.join(own, "horse_id").groupBy(parent).agg(
        F.sum("starts").alias("race_count"), F.sum("wins").alias("win_count")
    )
    return sums.withColumn("win_pct", S.ratio(F.col("win_count"), F.col("race_count")))


# ---- assembly ---------------------------------------------------------------
def horse_features(
    tables: RacingTables,
    as_of,
    starts: DataFrame = None,
    keep: list[str] = (),
    common: SharedCounts = None,
) -> DataFrame:
    """41 columns per horse; horses without any career row drop out.

    Everything is joined at horse grain from pre-aggregated counts. ``keep``
    adds plain HORSES columns for callers that look further things up; ``common``
    takes stored counts that other features of the date use as well.
    """
    common = common or shared_counts(tables, as_of, starts)
    form = common.form.select("horse_id", "last_date")
    base = tables.horses.select("horse_id", *ROLES.values(), *CODED, "birth_year")
    known = base.join(common.careers, "horse_id").join(form, "horse_id", "left")
    return with_roles(known, common).select(
        "horse_id",
        *keep,
        *age_columns(F.col("birth_year"), as_of),
        *onehot_columns(),
        *_role_columns(),
        *_career_columns(),
        *_recent_columns(as_of),
    )
