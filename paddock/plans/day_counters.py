"""Counters per person and day, from which features of any date are summed.

Starts are counted once per (kind, id, day, surface, band) and stored by day; months
hold the sums of their days. Both merge by addition, so totals up to a date are the
months before it and the days of its own month, and a window of days is those days.
Neither races nor records are read for that. A feed recounts only the days it touched.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.functions import scalars as S
from paddock.functions import vocab as V
from paddock.plans import people
from paddock.plans.horses import SharedCounts, career_sums
from paddock.plans.starts import FACTS, STARTER, as_date, one_year_before
from paddock.schema import RacingTables

KINDS = {"jockey": "jockey_id", "trainer": "trainer_id", "horse": "horse_id"}
KEYS = ["kind", "id", "surface", "band"]
DAYS = "kind string, id long, surface string, band int, starts long, wins long, day date"
MONTHS = "kind string, id long, surface string, band int, starts long, wins long, last_day date, month date"
# No counter, but a row that every counted day has, so that a day without starts
# replaces what was stored for it.
COUNTED = "counted"
WHO = "_who"

# Distances at which any band begins: what lies between two of them is one band here.
CUTS = sorted({edge + step for bands in (V.RACE_BANDS, V.JOCKEY_BANDS) for low, high in bands.values() for edge, step in ((low, 0), (high, 1)) if edge})


def fine_band(metres: Column) -> Column:
    """Number of the cuts up to a distance; null without a distance."""
    return F.when(metres.isNotNull(), sum((F.when(metres >= cut, 1).otherwise(0) for cut in CUTS), F.lit(0)))


def in_bands(low, high) -> Column:
    """Whether the counters' band lies within the band from ``low`` to ``high``."""
    inner = [i for i in range(len(CUTS) + 1) if (low is None or (i and CUTS[i - 1] >= low)) and (high is None or (i < len(CUTS) and CUTS[i] <= high + 1))]
    return F.col("band").isin(inner)


def month_of(day: dt.date) -> dt.date:
    return day.replace(day=1)


def count_starts(tables: RacingTables, first=None, last=None, days: list = None) -> DataFrame:
    """Counters of all days, or of those from ``first`` to ``last``, or of ``days``.
    The dates are conditions on ``race_date`` alone, which the scan can skip by."""
    races = tables.races.where(F.col("race_date").isNotNull())
    if first is not None:
        races = races.where(F.col("race_date") >= F.lit(as_date(first)))
    if last is not None:
        races = races.where(F.col("race_date") < F.lit(as_date(last) + dt.timedelta(days=1)))
    day = F.to_date("race_date")
    if days is not None:
        races = races.where(day.isin([as_date(d) for d in days]))
    starts = tables.race_records.select(*STARTER).join(races.select("race_id", *FACTS), "race_id")
    who = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(key).alias("id")) for kind, key in KINDS.items()])
    facts = starts.select(
        day.alias("day"), F.col("track_type").alias("surface"), fine_band(F.col("track_distance_m")).alias("band"), S.is_win().alias("win"), F.inline(who)
    )
    sums = [F.count(F.lit(1)).alias("starts"), F.count_if("win").alias("wins")]
    return summed(facts.where("id IS NOT NULL"), "day", sums).select(*[f.split()[0] for f in DAYS.split(", ")])


def summed(rows: DataFrame, by: str, sums: list[Column]) -> DataFrame:
    """``sums`` for each counter and ``by``, dealt as they are written: in ranges of
    ``by``, of which a large one is cut into several by who is counted. Hardly two starts
    share a counter, so combining them before the shuffle would only fill memory, and
    another shuffle before the write would move them again."""
    dealt = rows.withColumn(WHO, F.xxhash64("kind", "id")).repartitionByRange(by, WHO)
    return dealt.groupBy(*KEYS, by, WHO).agg(*sums).drop(WHO)


class DayCounters:
    """The stored counters: a table by day and one by month under ``root``.

    Writing a day replaces it, so a run that died is repeated. Months are written
    after their days; one writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _write(self, df: DataFrame, table: str, by: str, whole: bool) -> None:
        # Rows come in ranges of the date (see ``summed``).
        mode = "static" if whole else "dynamic"
        df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(by).parquet(f"{self.root}/{table}")

    def rebuild(self, tables: RacingTables) -> None:
        """Count all starts anew."""
        self._write(count_starts(tables), "days", "day", whole=True)
        self._write(self._month_sums(self.days()), "months", "month", whole=True)

    def extend(self, tables: RacingTables, days: list) -> None:
        """Recount some days from the base tables, of which only the races of these
        days are read, and the months they lie in from the stored days."""
        days = sorted({as_date(d) for d in days})
        if not days:
            return
        rows = count_starts(tables, days[0], days[-1], days)
        marks = self.spark.createDataFrame([(COUNTED, None, None, None, 0, 0, d) for d in days], DAYS)
        self._write(rows.unionByName(marks), "days", "day", whole=False)
        months = sorted({month_of(d) for d in days})
        stored = self._read("days", DAYS)
        touched = stored.where(F.trunc("day", "month").isin(months) & F.col("day").between(months[0], self._month_end(months[-1])))
        self._write(self._month_sums(touched), "months", "month", whole=False)

    @staticmethod
    def _month_end(month: dt.date) -> dt.date:
        return month_of(month + dt.timedelta(days=32)) - dt.timedelta(days=1)

    @staticmethod
    def _month_sums(days: DataFrame) -> DataFrame:
        sums = [F.sum(c).alias(c) for c in ("starts", "wins")]
        grouped = summed(days.withColumn("month", F.trunc("day", "month")), "month", [*sums, F.max("day").alias("last_day")])
        return grouped.select(*[f.split()[0] for f in MONTHS.split(", ")])

    def _read(self, table: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table}")

    def days(self) -> DataFrame:
        return self._read("days", DAYS).where(F.col("kind") != COUNTED)

    def months(self) -> DataFrame:
        return self._read("months", MONTHS).where(F.col("kind") != COUNTED)

    def parts(self, kind: str, as_of, since=None) -> DataFrame:
        """Counters of one kind that make up the totals to ``as_of``, and its days from
        ``since`` on: ``whole`` tells rows of the total, ``day`` is null for months.

        Both tables are cut to the partitions needed.
        """
        day = as_date(as_of)
        start = min(month_of(day), as_date(since) if since is not None else day)
        before = self.months().where((F.col("month") < F.lit(month_of(day))) & (F.col("kind") == kind))
        recent = self.days().where(F.col("day").between(F.lit(start), F.lit(day)) & (F.col("kind") == kind))
        names = ["id", "surface", "band", "starts", "wins"]
        old = before.select(*names, F.lit(None).cast("date").alias("day"), "last_day", F.lit(True).alias("whole"))
        new = recent.select(*names, "day", F.col("day").alias("last_day"), (F.col("day") >= F.lit(month_of(day))).alias("whole"))
        return old.unionByName(new)


def total(column: str, condition: Column = None) -> Column:
    """Sum of a counter over the rows of the total that satisfy a condition."""
    chosen = F.col("whole") if condition is None else F.col("whole") & condition
    return F.coalesce(F.sum(F.when(chosen, F.col(column))), F.lit(0).cast("long"))


def since(column: str, first: dt.date) -> Column:
    return F.coalesce(F.sum(F.when(F.col("day") >= F.lit(first), F.col(column))), F.lit(0).cast("long"))


def person_features(counters: DayCounters, as_of, person: str, bands: dict) -> DataFrame:
    """As ``people.person_features``, from stored counters."""
    day, pct = as_date(as_of), f"{person}_win_pct"
    rows = counters.parts(person, day, day - dt.timedelta(days=60))
    columns = {
        f"{person}_total_starts": total("starts"),
        f"{person}_total_wins": total("wins"),
        pct: S.ratio(total("wins"), total("starts")),
    }
    for days in (30, 60):
        first = day - dt.timedelta(days=days)
        columns[f"{pct}_last_{days}d"] = S.ratio(since("wins", first), since("starts", first))
    families = {f"{pct}_surface_{n.replace('_', '')}": F.col("surface") == label for label, n in V.SURFACES.items()}
    families.update({f"{pct}_dist_{n}": in_bands(*edges) for n, edges in bands.items()})
    for name, condition in families.items():
        columns[name] = F.coalesce(S.ratio(total("wins", condition), total("starts", condition)), F.lit(0.0))
    # Dealt before they are summed: there are some for each surface, band and month, but
    # a person's sums are wide, and every task would have its own of everybody.
    grouped = rows.repartition("id").groupBy(F.col("id").alias(f"{person}_id")).agg(*[c.alias(n) for n, c in columns.items()])
    # Whoever started in the last 60 days, though only before this month, has a month.
    return grouped.where(F.col(f"{person}_total_starts") > 0)


def jockeys(counters: DayCounters, as_of) -> DataFrame:
    return person_features(counters, as_of, "jockey", V.JOCKEY_BANDS)


def trainers(counters: DayCounters, tables: RacingTables, as_of) -> DataFrame:
    size = F.coalesce("trainer_active_horses", F.lit(0).cast("long"))
    found = person_features(counters, as_of, "trainer", V.RACE_BANDS)
    return found.join(people.stable_size(tables), "trainer_id", "left").withColumn("trainer_active_horses", size)


def shared_counts(counters: DayCounters, tables: RacingTables, as_of) -> SharedCounts:
    """What the features of horses, breeders and starters share, from stored counters:
    give it as ``common`` to ``horses_perf``, ``horses_recent``, ``horse_features``,
    ``breeders`` and ``race_features``."""
    first = one_year_before(as_of) + dt.timedelta(days=1)
    form = counters.parts("horse", as_of, first).groupBy(F.col("id").alias("horse_id")).agg(
        total("starts").alias("starts"), total("wins").alias("wins"), since("starts", first).alias("starts_1yr"), since("wins", first).alias("wins_1yr"),
        F.max("last_day").alias("last_date"),
    )
    own = counters.parts("trainer", as_of).groupBy(F.col("id").alias("trainer_id"))
    return SharedCounts(form, own.agg(total("starts").alias("starts"), total("wins").alias("wins")), career_sums(tables, as_of))


def breeders(counters: DayCounters, tables: RacingTables, as_of) -> DataFrame:
    return people.breeders(tables, as_of, common=shared_counts(counters, tables, as_of))


def touched_days(races: DataFrame, records: DataFrame, batch_races: DataFrame = None) -> list:
    """Days that new ``records`` (and new or changed ``batch_races``) fall on. There
    are no more of them than days in the calendar."""
    ids = records.select("race_id").distinct()
    found = races.join(ids, "race_id", "left_semi").select("race_date")
    if batch_races is not None:
        found = found.unionByName(batch_races.select("race_date"))
    rows = found.where("race_date IS NOT NULL").select(F.to_date("race_date").alias("day")).distinct().collect()
    return sorted(r["day"] for r in rows)
