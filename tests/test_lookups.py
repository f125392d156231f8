"""Small tables that much larger rows meet are broadcast, and starts are counted once."""

from __future__ import annotations

from dataclasses import replace

from conftest import rows
from pyspark.sql import functions as F

from paddock import session
from paddock.ml import score
from paddock.plans import assembly, horses
from paddock.plans import first_version as v1
from paddock.plans.starts import asof_starts
from paddock.session import lookup
from paddock.sql_functions import Bodies, register_functions
from suite.model_queries import NEW_RACE, entries

DAY = "2001-06-30"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def without_estimates(spark):
    """No table is broadcast by what the planner guesses."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


def test_lookup_is_broadcast_by_counted_size(spark, monkeypatch):
    without_estimates(spark)
    try:
        big, small = spark.range(100), spark.range(10).withColumn("x", F.lit(1))
        joined = big.join(lookup(small, "small"), "id", "left")
        assert "BroadcastHashJoin" in plan(joined) and joined.where("x = 1").count() == 10
        monkeypatch.setattr(session, "LOOKUP_BYTES", 10)
        assert "BroadcastHashJoin" not in plan(big.join(lookup(small, "small"), "id", "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_people_do_not_shuffle_starters(spark, tables):
    without_estimates(spark)
    try:
        assert plan(assembly.race_features(tables, DAY)).count("BroadcastHashJoin") >= 2
        rates = v1.race_features_v1(tables, ["race_id", "jockey_win_pct", "trainer_win_pct"])
        assert plan(rates).count("BroadcastHashJoin") >= 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_entries_cut_the_records_without_a_shuffle(spark, tables):
    without_estimates(spark)
    try:
        text = plan(score.prediction_input(tables, entries(tables), NEW_RACE))
        assert "LeftSemi, BuildRight" in text and "SortMergeJoin [horse_id" not in text.split("LeftSemi")[0][-60:]
        # Counts and money of a horse come from one pass.
        assert text.count("sum(prize_amount") <= 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_function_counts_starts_once(spark, tables):
    register_functions(spark, tables)
    found = spark.sql(f"SELECT * FROM horse_features(DATE '{DAY}')")
    # Starts and careers read the records once each.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation [l_orderkey") == 2
    assert rows(found) == rows(horses.horse_features(tables, DAY))


def test_a_horse_counts_for_each_of_its_breeders(spark, tables):
    first = tables.horses.orderBy("horse_id").limit(1)
    for breeder in (99, None):
        tables = replace(tables, horses=tables.horses.unionByName(first.withColumn("breeder_id", F.lit(breeder).cast("long"))))
    register_functions(spark, tables)
    base = {n: n for n in ("races", "race_records", "horses", "horse_careers")}
    found = spark.sql(Bodies(base).counted("f").replace("f.model_date", f"DATE '{DAY}'")).where("id IS NOT NULL")
    starts = asof_starts(tables, DAY)
    bred = starts.join(tables.horses.select("horse_id", "breeder_id"), "horse_id")
    kinds = [("horse", starts, "horse_id"), ("trainer", starts, "trainer_id"), ("breeder", bred, "breeder_id")]
    wanted = [(k, *r) for k, df, c in kinds for r in df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)), F.count_if(F.col("finish_place") == 1)).collect()]
    assert sorted(tuple(r) for r in found.select("kind", "id", "starts", "wins").collect()) == sorted(wanted)
