"""Properties of the feature plans, and the models built on them."""

import datetime as dt
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from paddock import quality
from paddock.functions import vocab as V
from paddock.ml import metrics, registry, score, train
from paddock.operators.rates import latest_per_key
from paddock.plans import assembly, first_version, horses, names, people
from paddock.plans.starts import asof_starts, one_year_before, up_to
from paddock.schema import MODEL_REGISTRY
from paddock.session import materialize
from paddock.sources.tables import read_history, save_bucketed
from paddock.sql_views import register_views
from suite.fixtures import AS_OF, view
from suite.model_queries import NEW_RACE, V1_COLUMNS, entries


def test_later_races_never_change_a_feature(tables):
    """Dropping everything after the cut-off leaves all as-of features alike."""
    past = tables.races.where(up_to(F.col("race_date"), AS_OF))
    cut = replace(tables, races=past)
    for build in (horses.horse_features, people.jockeys, people.trainers, people.breeders):
        assert rows(build(cut, AS_OF)) == rows(build(tables, AS_OF))


def test_shared_starts_give_the_same_features(tables):
    starts = materialize(asof_starts(tables, AS_OF), "starts")
    assert rows(assembly.race_features(tables, AS_OF, starts)) == rows(assembly.race_features(tables, AS_OF))


def test_one_row_per_starter(tables):
    ran = tables.race_records.where("start_order IS NOT NULL AND finish_place IS NOT NULL")
    known = horses.horse_features(tables, AS_OF).select("horse_id")
    assert assembly.race_features(tables, AS_OF).count() == ran.join(known, "horse_id").count()


def test_distance_edges_differ_by_person(spark, tables):
    races = spark.createDataFrame(
        [(1, dt.date(2025, 1, 1), 1200, "dobry"), (2, dt.date(2025, 1, 2), 1199, None)],
        "race_id bigint, race_date date, track_distance_m bigint, track_type string",
    )
    records = spark.createDataFrame(
        [(1, 7, 3, 4, 1), (2, 7, 3, 4, None)],
        "race_id bigint, horse_id bigint, jockey_id bigint, trainer_id bigint, finish_place bigint",
    )
    t = replace(tables, races=races, race_records=records)
    j = people.jockeys(t, "2025-01-31").first()
    assert (j.jockey_total_starts, j.jockey_win_pct_dist_l1200, j.jockey_win_pct_dist_1200_1799) == (2, 0.0, 1.0)
    p = people.trainers(t, dt.date(2025, 1, 31)).first()
    assert (p.trainer_win_pct_dist_l1200, p.trainer_win_pct_dist_1200_1799) == (0.5, 0.0)
    assert j.jockey_win_pct_last_30d == 0.5
    late = people.jockeys(t, "2025-06-30").first()
    assert late.jockey_win_pct_last_30d is None and late.jockey_win_pct_surface_dobry == 1.0


def test_leap_day():
    assert one_year_before("2024-02-29") == dt.date(2023, 2, 28)


def test_declared_columns(tables):
    assert len(horses.horse_features(tables, AS_OF).columns) == 41
    assert len(people.jockeys(tables, AS_OF).columns) == 18
    assert len(people.trainers(tables, AS_OF).columns) == 19
    assert len(people.breeders(tables, AS_OF).columns) == 9


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cut_off_and_columns_reach_the_scan(tables):
    plan = plan_of(people.jockeys(tables, AS_OF))
    assert "LessThan(o_orderdate,2001-07-01" in plan
    scans = [line for line in plan.split("\n") if "ReadSchema" in line]
    assert all("l_extendedprice" not in s and "o_totalprice" not in s for s in scans)


def test_asked_columns_prune_joins_and_windows(tables):
    plan = plan_of(quality.counts_by(tables, "distance_bucket"))
    assert "Window" not in plan and plan.count("Join") <= 4
    assert "Window" in plan_of(quality.rest_distribution(tables))


def test_bucketed_tables_join_without_shuffle(spark, tables):
    save_bucketed(tables.race_records, "t_records", "race_id", 4)
    save_bucketed(tables.races, "t_races", "race_id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = replace(tables, race_records=spark.table("t_records"), races=spark.table("t_races"))
        starts = asof_starts(t, AS_OF)
        assert "Exchange" not in plan_of(starts)
        assert rows(people.jockeys(t, AS_OF)) == rows(people.jockeys(tables, AS_OF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE t_records")
        spark.sql("DROP TABLE t_races")


def test_validation_shapes(tables):
    places = [r.finish_place for r in quality.finish_places(tables).collect()]
    assert places == sorted(places) and min(places) >= 1
    assert {r.distance_bucket for r in quality.counts_by(tables, "distance_bucket").collect()} <= {
        *V.DISTANCE_BUCKETS, "unknown",
    }
    r = quality.temperature_range(tables).first()
    assert -50 <= r.min_temp <= r.max_temp <= 50
    top = [r.horse_race_count for r in quality.largest_campaigns(tables).collect()]
    assert len(top) <= 10 and top == sorted(top, reverse=True)
    order = [r.rest_bucket for r in quality.rest_distribution(tables).collect()]
    assert order == [b for b in [*quality.REST_ORDER, "other"] if b in order]
    means = quality.specialty_means(tables).first()
    assert all(v is None or -7 <= v <= 7 for v in means)


def test_latest_per_key_takes_the_last_row(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 3, None), (2, 1, "c")], "k bigint, o bigint, v string")
    assert rows(latest_per_key(df, ["k"], ["o"])) == [(1, 3, None), (2, 1, "c")]


def test_names_that_several_share(spark, tables):
    people_named = spark.createDataFrame(
        [(1, "Kamińska"), (2, "KAMIŃSKA "), (3, "Łoś")], "jockey_id bigint, last_name string"
    )
    coaches = people_named.withColumnRenamed("jockey_id", "trainer_id")
    named = spark.createDataFrame([(9, "Farhat")], "horse_id bigint, horse_name string")
    t = replace(tables, horses=named, jockeys=people_named, trainers=coaches)
    card = spark.createDataFrame(
        [(1, " farhat", "Kamińska K.", "los")],
        "starting_pos bigint, horse_name string, jockey_last_name string, trainer_last_name string",
    )
    plain = names.resolve_names(card, t).collect()
    assert [(r.horse_id, r.jockey_id, r.trainer_id) for r in plain] == [(9, None, None)]
    lenient = names.resolve_names(card, t, strip_initial=True, fold=True).collect()
    assert sorted((r.horse_id, r.jockey_id, r.trainer_id) for r in lenient) == [(9, 1, 3), (9, 2, 3)]


def test_sql_views(spark, tables):
    register_views(spark, tables, AS_OF)
    n = spark.sql("SELECT COUNT(*) FROM race_features WHERE is_win").first()[0]
    assert n == assembly.race_features(tables, AS_OF).where("is_win").count()
    assert spark.sql("SELECT payout_zwc FROM races_payouts").count() == tables.races.count()


def test_views_start_no_job_where_no_key_is_hot(spark, tables):
    sc = spark.sparkContext
    try:
        sc.setJobGroup("lazy-views", "")
        register_views(spark, tables, AS_OF, rows_per_task=None)
        assert not sc.statusTracker().getJobIdsForGroup("lazy-views")
        lazy = spark.table("records_context")
        assert lazy.count() and sc.statusTracker().getJobIdsForGroup("lazy-views")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    register_views(spark, tables, AS_OF)
    assert rows(lazy) == rows(spark.table("records_context"))


# ---- models -----------------------------------------------------------------
def test_metrics_of_a_perfect_and_a_constant_model(spark):
    df = spark.range(1, 101).select(F.col("id").cast("double").alias("label"))
    perfect = metrics.regression_metrics(df.withColumn("prediction", F.col("label"))).first()
    assert perfect.r2_score == 1.0 and perfect.median_absolute_error == 0.0
    flat = df.withColumn("prediction", F.lit(50.5))
    got = metrics.regression_metrics(flat, rows_per_task=9).first()
    assert got.r2_score == pytest.approx(0.0) and got.median_absolute_error == 25.0
    sure = df.select((F.col("label") % 2).alias("label")).withColumns(
        {"prediction": F.col("label"), "label_prob": F.lit(1.0)}
    )
    got = metrics.classifier_metrics(sure).first()
    assert (got.accuracy, got.log_loss, got.f1_score) == (1.0, 0.0, 1.0)


def test_split_is_stable_and_complete(tables):
    keys = ["race_id", "horse_id"]
    fit, held = train.hash_split(tables.race_records, keys, 0.2)
    again = train.hash_split(tables.race_records.repartition(7), keys, 0.2)[1]
    assert rows(held.select(*keys)) == rows(again.select(*keys))
    assert fit.count() + held.count() == tables.race_records.count()
    assert 0.15 < held.count() / tables.race_records.count() < 0.25


def test_place_model_scores_a_race(spark, tables, tmp_path):
    features = first_version.race_features_v1(tables, V1_COLUMNS)
    trained = train.train_place_v1(features, max_iter=5)
    assert trained.labels == sorted(trained.labels) and "1" in trained.labels
    assert 0 < trained.metrics["accuracy"] <= 1 and 0.4 < trained.metrics["roc_auc"] <= 1
    card = entries(tables)
    out = score.predict_race(trained, tables, card, NEW_RACE).collect()
    assert [r.score for r in out] == sorted([r.score for r in out], reverse=True)
    assert all(0 <= r.prob_1 <= 1 for r in out)
    given = {r.horse_id: r.rest_days for r in score.prediction_input(tables, card, NEW_RACE).collect()}
    assert all(r.rest_days == given[r.horse_id] for r in out)
    row = registry.registry_row(
        spark.createDataFrame([trained.metrics]), "m", "logistic_reg", "finish_place", "all",
        F.current_timestamp().cast("timestamp_ntz"),
    )
    registry.register_run(row, str(tmp_path / "r"))
    registry.register_run(row, str(tmp_path / "r"))
    assert read_history(spark, str(tmp_path / "r"), MODEL_REGISTRY).where("accuracy > 0").count() == 2


def test_rating_model_beats_the_mean(spark, sf, tables):
    """A label that is a linear function of a feature must be recovered."""
    labels = view(spark, sf, "horse_rating_labels").withColumn(
        "rating_score", F.col("horse_id").cast("long") % 25 * 1.0
    )
    features = horses.horse_features(tables, AS_OF).withColumn("hint", F.col("horse_id") % 25)
    trained = train.train_rating(train.join_labels(features, labels, AS_OF))
    assert trained.metrics["r2_score"] > 0.8
