"""Names by collation, and all checks from one pass."""

from dataclasses import replace

from paddock import quality
from paddock.plans.first_version import race_features_v1
from paddock.plans.names import resolve_names


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lenient_names(spark, tables):
    """Strokes, accents, case and outer blanks; different letters still differ."""
    known = spark.createDataFrame([(1, "Łukasz Żółć"), (2, "Straße"), (3, "Ann"), (4, None)], "horse_id long, horse_name string")
    typed = spark.createDataFrame(
        [(1, "lukasz zolc"), (2, " ŁUKASZ  ŻÓŁĆ "), (3, "  ŁUKASZ ŻÓŁĆ  "), (4, "ann"), (5, "Anne"), (6, None), (7, "łukasz żółć")],
        "starting_pos long, horse_name string",
    )
    typed = typed.selectExpr("*", "CAST(NULL AS STRING) AS jockey_last_name", "CAST(NULL AS STRING) AS trainer_last_name")
    t = replace(tables, horses=known)
    ids = lambda **how: {r["starting_position"]: r["horse_id"] for r in resolve_names(typed, t, **how).collect()}
    assert ids(lenient=True) == {1: 1, 2: None, 3: 1, 4: 3, 5: None, 6: None, 7: 1}
    exact = ids()
    assert exact[1] is None and exact[3] == exact[7] == 1 and exact[4] == 3
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "CartesianProduct" not in plan_of(resolve_names(typed, t, lenient=True)) and "NestedLoop" not in plan_of(resolve_names(typed, t, lenient=True))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_initials_in_lenient_names(spark, tables):
    people = spark.createDataFrame([(5, "Kowalska")], "jockey_id long, last_name string")
    typed = spark.createDataFrame([(1, None, "KOWALSKA Ł.", None)], "starting_pos long, horse_name string, jockey_last_name string, trainer_last_name string")
    found = resolve_names(typed, replace(tables, jockeys=people), strip_initial=True, lenient=True)
    assert found.first()["jockey_id"] == 5


def test_all_checks_equal_each(tables):
    got = {(r["check"], r["label"], r["measure"]): r["value"] for r in quality.all_checks(tables).collect()}
    want = {}
    for column in ("finish_place", "distance_bucket", "temp_bucket", "track_surface_cat", "prize_amount_bucket"):
        want.update({(column, None if r[0] is None else str(r[0]), "cnt"): float(r["cnt"]) for r in quality.counts_by(tables, column).collect()})
    want.update({("horse_race_count", str(r[0]), "cnt"): float(r["cnt"]) for r in quality.largest_campaigns(tables).collect()})
    want.update({("rest_bucket", r[0], "distinct_horses"): float(r[1]) for r in quality.rest_distribution(tables).collect()})
    single = {
        "temperature_range": quality.temperature_range, "weather_totals": quality.weather_totals, "form_means": quality.form_means,
        "entity_count_range": quality.entity_count_range, "entity_rate_means": quality.entity_rate_means, "specialty_means": quality.specialty_means,
    }
    for name, one in single.items():
        want.update({(name, None, c): None if v is None else float(v) for c, v in one(tables).first().asDict().items()})
    close = lambda a, b: a == b or abs(a - b) < 1e-9
    assert set(got) == set(want) and all(close(got[x], want[x]) for x in want)


def test_all_checks_read_once(tables):
    """As many scans as one reading of all the features they need."""
    columns = ["horse_id", *quality.GROUPED, "temp_c", *quality.V.WEATHER_FLAGS, "win_rate_last_2", "win_rate_last_7", "win_pct_1600", "win_pct_2000"]
    columns += ["win_pct_delta_rain", "avg_place_delta_temp", *[f"{e}_{w}" for e in quality.ENTITIES for w in ("race_count", "win_pct")]]
    scans = lambda df: plan_of(df).count("FileScan")
    assert scans(quality.all_checks(tables)) == scans(race_features_v1(tables, columns))
