"""The chunked paths must equal the plain windows, with every key hot."""

import random

import pytest
from conftest import rows
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paddock.operators.ordered import over_recent_rows, percentile_per_key
from paddock.plans import first_version as v1
from paddock.plans.normalize import normalize_career_rows
from paddock.plans.races import race_context
from suite.fixtures import over
from suite.ingest_queries import CAREER_ROWS


def skewed(spark, n=600):
    """A third of the rows on one key, some on NULL, many small keys."""
    rng = random.Random(7)
    data = []
    for i in range(n):
        key = 1 if i % 3 == 0 else None if i % 11 == 0 else rng.randrange(2, 60)
        data.append((key, rng.randrange(40), i, rng.choice([None, 1, 2, 3, 9])))
    return spark.createDataFrame(data, "k bigint, day bigint, id bigint, place bigint")


def windows(w):
    return {
        "prev": F.lag("place").over(w),
        "mean5": F.avg(F.coalesce("place", F.lit(0))).over(w.rowsBetween(-5, -1)),
        "n5": F.count("id").over(w.rowsBetween(-5, -1)),
    }


@pytest.mark.parametrize("limit", [1, 7, 50, 10_000])
def test_recent_rows_equal_plain_window(spark, limit):
    df = skewed(spark)
    plain = df.withColumns(windows(W.partitionBy("k").orderBy("day", "id")))
    got = over_recent_rows(df, ["k"], ["day", "id"], 5, ["place"], windows, rows_per_task=limit)
    assert rows(got) == rows(plain)


@pytest.mark.parametrize("limit", [1, 13, 100])
def test_last_picked_row_is_carried_across_chunks(spark, limit):
    df = skewed(spark).withColumn("mark", F.when(F.col("id") % 29 == 0, F.col("id")))
    last = lambda w: {"seen": F.last("mark", ignorenulls=True).over(w)}
    plain = df.withColumns(last(W.partitionBy("k").orderBy("day", "id")))
    pick = F.col("mark").isNotNull()
    got = over_recent_rows(df, ["k"], ["day", "id"], 1, ["mark"], last, pick, rows_per_task=limit)
    assert rows(got) == rows(plain)


@pytest.mark.parametrize("q", [0.0, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("limit", [1, 10, 90])
def test_percentile_equals_builtin(spark, q, limit):
    df = skewed(spark).withColumn("x", F.when(F.col("place").isNotNull(), (F.col("id") * 37 % 101) / 4))
    plain = df.groupBy("k").agg(F.percentile("x", F.lit(q)).alias("p"), F.count(F.lit(1)).alias("n"))
    got = percentile_per_key(df, ["k"], "x", q, "p", {"n": F.count(F.lit(1))}, rows_per_task=limit)
    assert rows(got) == rows(plain)


def test_percentile_of_one_repeated_value(spark):
    df = spark.range(500).select(F.lit(1).alias("k"), F.lit(2.5).alias("x"))
    assert rows(percentile_per_key(df, ["k"], "x", 0.5, "p", rows_per_task=20)) == [(1, 2.5)]


def test_form_windows_with_hot_horses(tables):
    starters = v1.career_starters(tables, v1.RECORDS, v1.RACES).select("horse_id", *v1.ORDER, "finish_place")
    assert rows(v1.form_windows(starters, rows_per_task=20)) == rows(v1.form_windows(starters))


def test_race_context_with_hot_races(tables):
    assert rows(race_context(tables, rows_per_task=3)) == rows(race_context(tables))


def test_career_fold_with_hot_horses(spark, sf):
    raw = over(spark, sf, CAREER_ROWS)
    args = (raw, ["horse_id"], ["ts", "pos"])
    money = lambda df: df.withColumn("prize_amounts", F.round("prize_amounts", 6))
    assert rows(money(normalize_career_rows(*args, rows_per_task=5))) == rows(money(normalize_career_rows(*args)))
