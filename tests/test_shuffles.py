"""What the planner moves: steps that grow with the rows are shuffled once, narrow."""

import datetime as dt
import re

import pytest

from paddock import quality, schema
from paddock.ml import descent
from paddock.plans import day_counters
from paddock.plans.first_version import race_features_v1
from paddock.schema import RacingTables, with_schema


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


@pytest.fixture
def tables(spark):
    """Two horses of which one starts three times, with unknown people between."""
    day = [dt.datetime(2001, 1, 1), dt.datetime(2001, 1, 20), dt.datetime(2001, 6, 1)]
    races = spark.createDataFrame([(i, d, 1600) for i, d in enumerate(day)], "race_id long, race_date timestamp, track_distance_m long")
    records = spark.createDataFrame(
        [(1, 0, 1, 7, 3, 1), (2, 1, 1, None, 3, 2), (3, 2, 1, 7, None, 1), (4, 0, 2, 8, 3, 4), (5, 2, 2, 8, 4, None)],
        "race_record_id long, race_id long, horse_id long, jockey_id long, trainer_id long, finish_place long",
    )
    horses = spark.createDataFrame([(1, 50), (2, None)], "horse_id long, breeder_id long")
    careers = spark.createDataFrame([(1, 2001, "A", 3, 1), (1, 2001, "B", 2, 0), (2, 2001, "A", 5, 1), (2, None, "A", 9, 9)], "horse_id long, race_year long, race_type string, race_count long, race_won_count long")
    made = {"races": races, "race_records": records, "horses": horses, "horse_careers": careers}
    return RacingTables(**{n: with_schema(made[n], s) if n in made else spark.createDataFrame([], s) for n, s in schema.BASE_TABLES.items()})


@pytest.fixture
def shuffled_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_starters_meet_a_horse_once(tables, shuffled_joins):
    rows = race_features_v1(tables, rows_per_task=None)
    got = sorted((r.race_id, r.horse_id, r.horse_race_count, r.hj_podium_rate, r.ht_podium_rate, r.rest_days) for r in rows.collect())
    assert got == [(0, 1, 5, 1.0, 1.0, None), (0, 2, 5, 0.0, 0.0, None), (1, 1, 5, None, 1.0, 19), (2, 1, 5, 1.0, None, 132)]
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan(rows))
    assert not [k for k in keys if "horse_id" in k and "race_year" in k]


def test_only_rest_buckets_tell_horses_apart(tables):
    checks = quality.all_checks(tables)
    found = {(r.label, r.measure): r.value for r in checks.where("check = 'rest_bucket'").collect()}
    assert set(found.values()) <= {1.0, 2.0} and sum(found.values()) == 4.0
    assert "count(distinct" not in plan(checks)


def test_counters_are_shuffled_once(tables):
    text = plan(day_counters.count_starts(tables))
    assert not re.search(r"hashpartitioning\(kind", text) and text.count("rangepartitioning(day") == 1


def test_descent_reads_columns(spark, monkeypatch):
    """Steps read a plain column for each input, not an array built for every row."""
    seen = []
    monkeypatch.setattr(descent, "materialize", lambda df, label: seen.append(df.dtypes) or df)
    rows = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, None, 5.0)], "a double, b double, y double")
    weights = descent.descend(rows, "y", ["a", "b"], 0.1, 1)
    assert seen == [[("x0", "double"), ("x1", "double"), ("y", "double")]]
    assert [round(w, 9) for w in weights.values[0]] == [0.4, 0.1, 0.0]
