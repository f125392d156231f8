"""The first feature version, its parts, and the validation checks over it."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from paddock import quality
from paddock.functions import vocab as V
from paddock.operators.rates import latest_per_key
from paddock.plans import first_version as v1
from suite.feature_queries import RR, SURFACE_SQL, TEMP_SQL, bucket_sql, prize_sql
from suite.fixtures import racing, text_of
from suite.registry import dbl, query, rnd, sql_list

BASE = f"{RR} horses horse_careers"
KEY = "race_record_id, race_id, horse_id"
RAIN = f"a.weather IN {sql_list(V.RAINY)}"

# Placed starters with a career row in their year, as the reference SQL sees them.
STARTERS = """cy AS (SELECT horse_id, race_year, CAST(SUM(race_count) AS BIGINT) AS n, SUM(race_won_count) AS w
        FROM horse_careers GROUP BY horse_id, race_year),
    base AS (SELECT r.*, a.race_date, CAST(a.race_date AS DATE) AS day, a.track_distance_m, a.temperature_c,
            a.weather, a.track_type, a.category_id, a.race_group, a.subtype,
            c.n AS horse_race_count, c.w / NULLIF(CAST(c.n AS DOUBLE), 0) AS horse_win_pct
        FROM race_records r JOIN races a ON a.race_id = r.race_id
        JOIN cy c ON c.horse_id = r.horse_id AND c.race_year = EXTRACT(YEAR FROM a.race_date)
        WHERE r.finish_place >= 1)"""
ORDERED = "PARTITION BY horse_id ORDER BY race_date, race_id, race_record_id"


def mean_sql(condition: str, n: int, name: str) -> str:
    hit = f"CASE WHEN {condition} THEN 1.0 ELSE 0.0 END"
    return dbl(f"AVG({hit}) OVER ({ORDERED} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)", name)


GAP = f"date_diff('day', LAG(day) OVER ({ORDERED}), day)"
WON = f"CASE WHEN LAG(finish_place) OVER ({ORDERED}) = 1 THEN 1 ELSE 0 END"
FORM = f"""form AS (SELECT {KEY}, day, {GAP} AS rest_days, CAST({WON} AS BIGINT) AS won_last_race,
    {mean_sql("finish_place = 1", 2, "win_rate_last_2")}, {mean_sql("finish_place = 1", 7, "win_rate_last_7")},
    {mean_sql("finish_place > 1", 3, "loss_rate_last_3")}, {mean_sql("finish_place > 1", 5, "loss_rate_last_5")}
    FROM base)"""


def rest_sql(column: str) -> str:
    arms = " ".join(f"WHEN {column} < {edge} THEN '{label}'" for edge, label in V.REST_BUCKETS)
    return f"CASE {arms} ELSE 'other' END"


def starters(spark, sf):
    return v1.career_starters(racing(spark, sf), v1.RECORDS, v1.RACES)


@query(
    "career_year_join",
    f"WITH {STARTERS} SELECT {KEY}, horse_race_count, {dbl('horse_win_pct', 'horse_win_pct')} FROM base",
    BASE,
)
def _(spark, sf):
    return starters(spark, sf).select(*KEY.split(", "), "horse_race_count", "horse_win_pct")


def form_query(name: str, columns: str, picked: str = None):
    @query(name, f"WITH {STARTERS}, {FORM} SELECT {KEY}, {picked or columns} FROM form", BASE)
    def _(spark, sf):
        return v1.form_windows(starters(spark, sf)).select(*KEY.split(", "), *columns.split(", "))


form_query("rest_days", "rest_days")
form_query("rest_bucket", "rest_bucket", f"{rest_sql('rest_days')} AS rest_bucket")
form_query("won_last_race", "won_last_race")
form_query("form_momentum", "win_rate_last_2, win_rate_last_7, loss_rate_last_3, loss_rate_last_5")


@query(
    "latest_per_key",
    f"""WITH {STARTERS}, {FORM}, ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY horse_id
            ORDER BY day DESC, race_id DESC, race_record_id DESC) AS rn FROM form)
        SELECT horse_id, race_id, race_record_id, CAST(day AS VARCHAR) AS race_date, rest_days
        FROM ranked WHERE rn = 1""",
    BASE,
)
def _(spark, sf):
    form = v1.form_windows(starters(spark, sf)).select("horse_id", *v1.ORDER, "rest_days")
    latest = latest_per_key(form, ["horse_id"], v1.ORDER)
    return text_of(latest.withColumn("race_date", F.to_date("race_date")), "race_date")


# ---- whole-history rates, as correlated lookups -----------------------------
def lookup(top: str, where: str, source: str = "race_records x") -> str:
    return f"(SELECT {top} FROM {source} WHERE {where})"


def rate_of(hit: str, where: str, source: str = "race_records x") -> str:
    return lookup(f"COUNT(*) FILTER (WHERE {hit}) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0)", where, source)


# Each lookup is written once per entity and joined, or the correlated form is
# decorrelated by the engine; both read the whole record table.
WITH_RACE = "race_records x JOIN races a ON a.race_id = x.race_id"
WITH_HORSE = "race_records x JOIN horses k ON k.horse_id = x.horse_id"
WIN, PODIUM = "x.finish_place = 1", "x.finish_place <= 3"
MINE = "x.horse_id = r.horse_id"
RATES = {
    "career_race_count": lookup("COUNT(*)", MINE),
    "career_win_pct": rate_of(WIN, MINE),
    "career_prize_sum": lookup("COALESCE(SUM(x.prize_amount), 0)", MINE),
    "jockey_race_count": lookup("COUNT(*)", "x.jockey_id = r.jockey_id"),
    "jockey_win_pct": rate_of(WIN, "x.jockey_id = r.jockey_id"),
    "trainer_race_count": lookup("COUNT(*)", "x.trainer_id = r.trainer_id"),
    "trainer_win_pct": rate_of(WIN, "x.trainer_id = r.trainer_id"),
    "breeder_race_count": lookup("COUNT(*)", "k.breeder_id = h.breeder_id", WITH_HORSE),
    "breeder_win_pct": rate_of(WIN, "k.breeder_id = h.breeder_id", WITH_HORSE),
    "father_race_count": lookup("COUNT(*)", "k.father_id = h.father_id", WITH_HORSE),
    "father_win_count": lookup(f"COUNT(*) FILTER (WHERE {WIN})", "k.father_id = h.father_id", WITH_HORSE),
    "father_win_pct": rate_of(WIN, "k.father_id = h.father_id", WITH_HORSE),
    "hj_podium_rate": rate_of(PODIUM, f"{MINE} AND x.jockey_id = r.jockey_id"),
    "ht_podium_rate": rate_of(PODIUM, f"{MINE} AND x.trainer_id = r.trainer_id"),
    "hb_podium_rate": rate_of(PODIUM, f"{MINE} AND k.breeder_id = h.breeder_id", WITH_HORSE),
    "win_pct_1600": rate_of(WIN, f"{MINE} AND a.track_distance_m = 1600", WITH_RACE),
    "win_pct_2000": rate_of(WIN, f"{MINE} AND a.track_distance_m = 2000", WITH_RACE),
    "win_pct_delta_rain": rate_of(WIN, f"{MINE} AND {RAIN}", WITH_RACE)
    + " - "
    + rate_of(WIN, f"{MINE} AND NOT ({RAIN})", WITH_RACE),
    "avg_place_delta_temp": lookup("AVG(x.finish_place)", f"{MINE} AND a.temperature_c > 20", WITH_RACE)
    + " - "
    + lookup("AVG(x.finish_place)", f"{MINE} AND a.temperature_c <= 20", WITH_RACE),
}
COUNTS = [c for c in RATES if c.endswith("_count")]


def rates_sql(names: list[str]) -> str:
    form = lambda c: rnd if c == "career_prize_sum" else dbl
    return ", ".join(f"{RATES[c]} AS {c}" if c in COUNTS else form(c)(RATES[c], c) for c in names)


def rate_query(name: str, columns: list[str]):
    sql = f"""WITH {STARTERS} SELECT r.race_record_id, r.race_id, r.horse_id, {rates_sql(columns)}
        FROM base r LEFT JOIN horses h ON h.horse_id = r.horse_id"""

    @query(name, sql, BASE)
    def _(spark, sf):
        return v1.race_features_v1(racing(spark, sf), [*KEY.split(", "), *columns])


PEOPLE = ["jockey", "trainer", "breeder"]
rate_query("entity_rates", [f"{p}_{m}" for p in PEOPLE for m in ("race_count", "win_pct")])
rate_query("synergy_rates", ["hj_podium_rate", "ht_podium_rate", "hb_podium_rate"])
rate_query("specialty_deltas", ["win_pct_1600", "win_pct_2000", "win_pct_delta_rain", "avg_place_delta_temp"])

OWN = {
    **{c: f"r.{c}" for c in "horse_id race_id jockey_id trainer_id".split()},
    "breeder_id": "h.breeder_id",
    "father_id": "h.father_id",
    "finish_place": "r.finish_place",
    "distance_m": "r.track_distance_m",
    "distance_bucket": bucket_sql("r.track_distance_m"),
    "temp_c": "CASE WHEN r.temperature_c BETWEEN -50 AND 50 THEN r.temperature_c END",
    "temp_bucket": TEMP_SQL.format(c="r.temperature_c"),
    **{n: f"CAST(COALESCE(weather IN {sql_list(w)}, FALSE) AS BIGINT)" for n, w in V.WEATHER_FLAGS.items()},
    "track_surface_cat": SURFACE_SQL,
    **{c: f"r.{c}" for c in "category_id race_group subtype horse_race_count prize_amount".split()},
    "horse_win_pct": "r.horse_win_pct",
    "jockey_weight_kg": "CASE WHEN r.jockey_weight_kg <= 100 THEN r.jockey_weight_kg END",
    **{c: f"f.{c}" for c in v1.FORM if c != "rest_bucket"},
    "rest_bucket": rest_sql("f.rest_days"),
    "prize_amount_bucket": prize_sql(RATES["career_prize_sum"]),
}


def v1_sql(columns: list[str]) -> str:
    """The view ``v`` with the given columns only."""
    parts = [f"{OWN[c]} AS {c}" if c in OWN else rates_sql([c]) for c in columns]
    return f"""WITH {STARTERS}, {FORM}, v AS (SELECT {", ".join(parts)}
        FROM base r JOIN form f ON f.race_record_id = r.race_record_id AND f.race_id = r.race_id
            AND f.horse_id = r.horse_id
        LEFT JOIN horses h ON h.horse_id = r.horse_id)"""


@query("race_features_v1", f"{v1_sql([*OWN, *RATES])} SELECT * FROM v", BASE, "career_prize_sum")
def _(spark, sf):
    return v1.race_features_v1(racing(spark, sf))


# ---- validation checks ------------------------------------------------------
def check(name: str, sql: str, run, rounds: str = ""):
    columns = [c for c in [*OWN, *RATES] if re.search(rf"\b{c}\b", sql)]

    @query(name, f"{v1_sql(columns)} {sql}", BASE, rounds)
    def _(spark, sf):
        return run(racing(spark, sf))


def count_check(name: str, column: str):
    check(
        name,
        f"SELECT {column}, COUNT(*) AS cnt FROM v GROUP BY {column}",
        lambda t: quality.counts_by(t, column),
    )


check("validate_finish_place", "SELECT finish_place, COUNT(*) AS cnt FROM v GROUP BY 1", quality.finish_places)
count_check("validate_distance_bucket", "distance_bucket")
check(
    "validate_temp_range",
    "SELECT MIN(temp_c) AS min_temp, MAX(temp_c) AS max_temp, COUNT(*) - COUNT(temp_c) AS null_clamped FROM v",
    quality.temperature_range,
)
count_check("validate_temp_bucket", "temp_bucket")
check(
    "validate_weather",
    "SELECT "
    + ", ".join(f"CAST(SUM({c}) AS BIGINT) AS {c.removeprefix('is_')}_cnt" for c in V.WEATHER_FLAGS)
    + " FROM v",
    quality.weather_totals,
)
count_check("validate_surface", "track_surface_cat")
check(
    "topk_campaigns",
    """SELECT horse_race_count, COUNT(*) AS cnt FROM v GROUP BY horse_race_count
       ORDER BY horse_race_count DESC LIMIT 10""",
    quality.largest_campaigns,
)
count_check("validate_prize_bucket", "prize_amount_bucket")
check(
    "rest_distribution",
    "SELECT rest_bucket, COUNT(DISTINCT horse_id) AS distinct_horses FROM v GROUP BY rest_bucket",
    quality.rest_distribution,
)
check(
    "validate_form",
    f"""SELECT {rnd("AVG(win_rate_last_2)", "avg_win2_for_7starters")}, {rnd("AVG(win_rate_last_7)", "avg_win7")}
        FROM v WHERE win_rate_last_7 IS NOT NULL""",
    quality.form_means,
    "avg_win2_for_7starters avg_win7",
)
check(
    "validate_entity_counts",
    "SELECT "
    + ", ".join(f"{f}({p}_race_count) AS {f.lower()}_{p[0]}c" for p in PEOPLE for f in ("MIN", "MAX"))
    + " FROM v",
    quality.entity_count_range,
)
check(
    "validate_entity_rates",
    "SELECT " + ", ".join(rnd(f"AVG({p}_win_pct)", f"avg_{p[0]}w") for p in PEOPLE) + " FROM v",
    quality.entity_rate_means,
    "avg_jw avg_tw avg_bw",
)
check(
    "validate_specialty",
    f"""SELECT {rnd("AVG(win_pct_1600)", "avg_w1600")}, {rnd("AVG(win_pct_2000)", "avg_w2000")},
        {rnd("AVG(win_pct_delta_rain)", "avg_rain_delta")}, {rnd("AVG(avg_place_delta_temp)", "avg_temp_delta")} FROM v""",
    quality.specialty_means,
    "avg_w1600 avg_w2000 avg_rain_delta avg_temp_delta",
)


# ---- all checks from one pass -----------------------------------------------
def long_rows(check_name: str, source: str, **measures: str) -> list[str]:
    return [
        f"SELECT '{check_name}' AS \"check\", CAST(NULL AS VARCHAR) AS label, '{name}' AS measure, {dbl(expr, 'value')} FROM {source}"
        for name, expr in measures.items()
    ]


def long_counts(column: str, measure: str = "cnt", expr: str = "COUNT(*)", tail: str = "") -> str:
    inner = f"SELECT {column} AS k, {expr} AS n FROM v GROUP BY 1 {tail}"
    return f"SELECT '{column}', CAST(k AS VARCHAR), '{measure}', CAST(n AS DOUBLE) FROM ({inner}) AS g_{column}"


LONG = [
    *long_rows("temperature_range", "v", min_temp="MIN(temp_c)", max_temp="MAX(temp_c)", null_clamped="COUNT(*) - COUNT(temp_c)"),
    *long_rows("weather_totals", "v", **{f"{c.removeprefix('is_')}_cnt": f"SUM({c})" for c in V.WEATHER_FLAGS}),
    *long_rows("form_means", "v WHERE win_rate_last_7 IS NOT NULL", avg_win2_for_7starters="AVG(win_rate_last_2)", avg_win7="AVG(win_rate_last_7)"),
    *long_rows("entity_count_range", "v", **{f"{f.lower()}_{p[0]}c": f"{f}({p}_race_count)" for p in PEOPLE for f in ("MIN", "MAX")}),
    *long_rows("entity_rate_means", "v", **{f"avg_{p[0]}w": f"AVG({p}_win_pct)" for p in PEOPLE}),
    *long_rows("specialty_means", "v", avg_w1600="AVG(win_pct_1600)", avg_w2000="AVG(win_pct_2000)", avg_rain_delta="AVG(win_pct_delta_rain)", avg_temp_delta="AVG(avg_place_delta_temp)"),
    *[long_counts(c) for c in "finish_place distance_bucket temp_bucket track_surface_cat prize_amount_bucket".split()],
    long_counts("horse_race_count", tail="ORDER BY 1 DESC NULLS LAST LIMIT 10"),
    long_counts("rest_bucket", "distinct_horses", "COUNT(DISTINCT horse_id)"),
]
check(
    "validate_all",
    'SELECT "check", label, measure, ROUND(value, 6) AS value FROM (' + "\nUNION ALL\n".join(LONG) + ") AS every_check",
    quality.all_checks,
    "value",
)
