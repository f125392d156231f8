"""Features from stored day counters against those from all starts."""

import datetime as dt
import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from paddock.functions import vocab as V
from paddock.plans import day_counters, horses, people
from paddock.plans.day_counters import CUTS, DayCounters, fine_band, in_bands
from paddock.plans.starts import after, up_to

DAYS = ("1996-02-29", "1998-01-01", "2001-06-30")
LAST = "1999-12-31"


@pytest.fixture(autouse=True, scope="module")
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def recent(tables):
    """The races of three years, so that few days are written."""
    at = F.col("race_date")
    return replace(tables, races=tables.races.where(after(at, "1997-11-30") & up_to(at, "1998-12-31")))


@pytest.fixture(scope="module")
def counters(spark, recent, tmp_path_factory):
    built = DayCounters(spark, str(tmp_path_factory.mktemp("counters")))
    early = replace(recent, races=recent.races.where(up_to(F.col("race_date"), "1998-11-15")))
    built.rebuild(early)
    rest = recent.races.where(after(F.col("race_date"), "1998-11-15"))
    built.extend(recent, day_counters.touched_days(recent.races, recent.race_records.join(rest, "race_id", "left_semi")))
    return built


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same(a, b):
    assert a.columns == b.columns
    a, b = sorted_rows(a), sorted_rows(b)
    close = lambda x, y: x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-12))
    assert len(a) == len(b) and all(close(x, y) for p, q in zip(a, b) for x, y in zip(p, q))
    return len(a)


def test_bands(spark):
    """Every band is made of whole pieces, at each edge and beside it."""
    metres = spark.createDataFrame([(m,) for edge in CUTS for m in (edge - 1, edge, edge + 1)] + [(0,), (9000,), (None,)], "m long")
    rows = metres.select("m", fine_band(F.col("m")).alias("band"))
    for low, high in (*V.RACE_BANDS.values(), *V.JOCKEY_BANDS.values()):
        for r in rows.select("m", in_bands(low, high).alias("hit")).collect():
            want = None if r["m"] is None else (low is None or r["m"] >= low) and (high is None or r["m"] <= high)
            assert r["hit"] == want


@pytest.mark.parametrize("day", ["1998-01-15", "1998-11-30", "1998-12-31", "1997-11-01"])
def test_equal_to_all_starts(counters, recent, day):
    n = same(day_counters.jockeys(counters, day), people.jockeys(recent, day))
    same(day_counters.trainers(counters, recent, day), people.trainers(recent, day))
    assert (n == 0) == (day < "1997-12")
    if n:
        common = day_counters.shared_counts(counters, recent, day)
        same(day_counters.breeders(counters, recent, day), people.breeders(recent, day))
        same(horses.horse_features(recent, day, common=common), horses.horse_features(recent, day))


def test_only_these_days_are_read(spark, tables, tmp_path):
    """Adding a day reads the races of that day; features read no start at all."""
    tables.races.write.parquet(f"{tmp_path}/races")
    stored = replace(tables, races=spark.read.parquet(f"{tmp_path}/races"))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    text = plan(day_counters.count_starts(stored, "1998-12-01", "1998-12-01", ["1998-12-01"]))
    assert "GreaterThanOrEqual(race_date,1998-12-01" in text and "LessThan(race_date,1998-12-02" in text


def test_partitions_read(counters):
    text = day_counters.jockeys(counters, "1998-12-31")._jdf.queryExecution().executedPlan().toString()
    assert "/races" not in text and "month#" in text
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert len(scans) == 2 and all("PartitionFilters: [isnotnull(" in s for s in scans)
    assert "1998-11-01" in text and "1998-12-31" in text


def test_extend_again_changes_nothing(spark, counters, recent):
    before = sorted_rows(counters.days()), sorted_rows(counters.months())
    counters.extend(recent, ["1998-11-20", dt.date(1998, 12, 3), "1998-11-20"])
    counters.extend(recent, [])
    assert (sorted_rows(counters.days()), sorted_rows(counters.months())) == before


def test_emptied_day(spark, recent, tmp_path):
    """A day whose races are gone loses its counters, and so does its month."""
    built = DayCounters(spark, str(tmp_path))
    month = replace(recent, races=recent.races.where(F.col("race_date").between(F.lit("1998-03-01"), F.lit("1998-03-31"))))
    built.rebuild(month)
    day = month.races.select(F.to_date("race_date").alias("d")).orderBy("d").first()["d"]
    less = replace(month, races=month.races.where(F.to_date("race_date") != F.lit(day)))
    built.extend(less, [day])
    same(day_counters.jockeys(built, "1998-03-31"), people.jockeys(less, "1998-03-31"))
    same(day_counters.jockeys(built, "1998-04-30"), people.jockeys(less, "1998-04-30"))
