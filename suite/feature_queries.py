"""Point-in-time features: entity tables, race views and their assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from paddock.functions import scalars as S
from paddock.functions import vocab as V
from paddock.operators.rates import band_families, rates_by, share, starts_and_wins, surface_families
from paddock.plans import assembly, horses, names, people, races
from paddock.plans.starts import after, asof_starts, one_year_before, up_to
from paddock.session import materialize
from suite.fixtures import AS_OF, racing, text_of, view
from suite.registry import dbl, query, rnd, sql_list

MEANS = "breeder_avg_win_pct breeder_avg_earnings"
D = f"DATE '{AS_OF}'"
RR = "race_records races"
STARTS = f"""starts AS (
    SELECT r.race_id, r.horse_id, r.jockey_id, r.trainer_id, r.finish_place,
           CAST(a.race_date AS DATE) AS day, a.track_type, a.track_distance_m
    FROM race_records r JOIN races a ON a.race_id = r.race_id
    WHERE CAST(a.race_date AS DATE) <= {D})"""


def band_sql(column: str, low, high) -> str:
    if low is None:
        return f"{column} <= {high}"
    return f"{column} >= {low}" if high is None else f"{column} BETWEEN {low} AND {high}"


def flag_sql(condition: str, name: str) -> str:
    return f"COALESCE({condition}, FALSE) AS {name}"


# ---- projections ------------------------------------------------------------
def bucket_sql(column: str) -> str:
    arms = " ".join(f"WHEN {band_sql(column, *e)} THEN '{n}'" for n, e in V.DISTANCE_BUCKETS.items())
    return f"CASE {arms} ELSE 'unknown' END"


@query("distance_bucket", f"SELECT race_id, {bucket_sql('track_distance_m')} AS distance_bucket FROM races", "races")
def _(spark, sf):
    return view(spark, sf, "races").select(
        "race_id", S.distance_bucket(F.col("track_distance_m")).alias("distance_bucket")
    )


@query(
    "clamp_to_null",
    """SELECT r.race_record_id, r.race_id, r.horse_id,
              CASE WHEN a.temperature_c BETWEEN -50 AND 50 THEN a.temperature_c END AS temp_c,
              CASE WHEN r.jockey_weight_kg <= 100 THEN r.jockey_weight_kg END AS jockey_weight_kg
       FROM race_records r JOIN races a USING (race_id)""",
    RR,
)
def _(spark, sf):
    t = racing(spark, sf)
    joined = t.race_records.join(t.races.select("race_id", "temperature_c"), "race_id")
    return joined.select(
        "race_record_id",
        "race_id",
        "horse_id",
        S.clamp_to_null(F.col("temperature_c"), *V.TEMP_RANGE).alias("temp_c"),
        S.clamp_to_null(F.col("jockey_weight_kg"), None, V.MAX_JOCKEY_WEIGHT).alias("jockey_weight_kg"),
    )


TEMP_SQL = """CASE WHEN {c} > 30 THEN 'temp_gt_30' WHEN {c} >= 23 AND {c} <= 30 THEN 'temp_23_30'
    WHEN {c} >= 15 AND {c} <= 22 THEN 'temp_15_22' WHEN {c} >= 7 AND {c} <= 14 THEN 'temp_7_14'
    WHEN {c} <= 6 THEN 'temp_le_6' ELSE 'temp_unknown' END"""


@query("temp_bucket", f"SELECT race_id, {TEMP_SQL.format(c='temperature_c')} AS temp_bucket FROM races", "races")
def _(spark, sf):
    return view(spark, sf, "races").select("race_id", S.temp_bucket(F.col("temperature_c")).alias("temp_bucket"))


def weather_sql(as_int: bool) -> str:
    out = []
    for name, words in V.WEATHER_FLAGS.items():
        hit = f"COALESCE(weather IN {sql_list(words)}, FALSE)"
        out.append(f"CAST({hit} AS BIGINT) AS {name}_1" if as_int else f"{hit} AS {name}")
    return ", ".join(out)


@query("weather_flags", f"SELECT race_id, {weather_sql(False)}, {weather_sql(True)} FROM races", "races")
def _(spark, sf):
    weather = F.col("weather")
    ints = [c.alias(f"{n}_1") for n, c in zip(V.WEATHER_FLAGS, S.weather_flags(weather, as_int=True))]
    return view(spark, sf, "races").select("race_id", *S.weather_flags(weather), *ints)


SURFACE_SQL = f"CASE WHEN track_type IN {sql_list(V.SURFACE_CATEGORIES)} THEN track_type ELSE 'other' END"


@query("surface_cat", f"SELECT race_id, {SURFACE_SQL} AS track_surface_cat FROM races", "races")
def _(spark, sf):
    return view(spark, sf, "races").select(
        "race_id", S.surface_category(F.col("track_type")).alias("track_surface_cat")
    )


def prize_sql(c: str) -> str:
    arms = " ".join(f"WHEN {c} <= {edge} THEN '{label}'" for edge, label in V.PRIZE_BUCKETS)
    return f"CASE WHEN {c} = 0 THEN 'p_0' {arms} ELSE 'p_16000+' END"


@query(
    "prize_bucket",
    f"""WITH sums AS (SELECT horse_id, SUM(prize_amount) AS total FROM race_records GROUP BY horse_id)
        SELECT r.race_record_id, r.race_id, r.horse_id, ROUND(s.total, 2) AS career_prize_sum,
               {prize_sql('r.prize_amount')} AS own_bucket, {prize_sql('s.total')} AS prize_amount_bucket
        FROM race_records r JOIN sums s ON s.horse_id = r.horse_id""",
    "race_records",
)
def _(spark, sf):
    records = view(spark, sf, "race_records")
    sums = records.groupBy("horse_id").agg(F.sum("prize_amount").alias("total"))
    return records.join(sums, "horse_id").select(
        "race_record_id",
        "race_id",
        "horse_id",
        F.round("total", 2).alias("career_prize_sum"),
        S.prize_bucket(F.col("prize_amount")).alias("own_bucket"),
        S.prize_bucket(F.col("total")).alias("prize_amount_bucket"),
    )


@query(
    "horse_onehot",
    "SELECT horse_id, "
    + ", ".join(
        [flag_sql(f"horse_sex = '{v}'", n) for v, n in V.SEXES.items()]
        + [flag_sql(f"breed = '{v}'", n) for v, n in V.BREEDS.items()]
        + [flag_sql(f"color_name_pl = '{c}'", f"color_{c}") for c in V.COLORS]
    )
    + " FROM horses",
    "horses",
)
def _(spark, sf):
    return view(spark, sf, "horses").select("horse_id", *horses.onehot_columns())


DIST_FLAGS = ", ".join(flag_sql(band_sql("track_distance_m", *e), f"dist_{n}") for n, e in V.RACE_BANDS.items())


@query("distance_onehot", f"SELECT race_id, {DIST_FLAGS} FROM races", "races")
def _(spark, sf):
    return view(spark, sf, "races").select("race_id", *S.band_flags(F.col("track_distance_m")))


STYLE_SQL = (
    "CAST(CASE race_style "
    + " ".join(f"WHEN '{k}' THEN {v}" for k, v in V.STYLE_EASE.items())
    + " ELSE NULL END AS BIGINT)"
)


@query("style_ease_score", f"SELECT race_id, {STYLE_SQL} AS style_ease_score FROM races", "races")
def _(spark, sf):
    score = S.style_ease_score(F.col("race_style"))
    return view(spark, sf, "races").select("race_id", score.alias("style_ease_score"))


RACE_ONEHOT = ", ".join(
    [flag_sql(f"race_group = '{v}'", n) for v, n in V.RACE_GROUPS.items()]
    + [flag_sql(f"category_breed = '{v}'", n) for v, n in V.BREEDS.items()]
    + [flag_sql(f"country_code IN {sql_list(V.POLAND_CODES)}", "country_PL")]
    + [flag_sql("city_name = 'Warsaw'", "city_Warsaw")]
    + [flag_sql(f"track_type = '{v}'", f"surface_{n}") for v, n in V.SURFACES.items()]
)


@query("race_onehot", f"SELECT race_id, {RACE_ONEHOT} FROM races", "races")
def _(spark, sf):
    return view(spark, sf, "races").select(
        "race_id",
        *S.one_hot(F.col("race_group"), V.RACE_GROUPS),
        *S.one_hot(F.col("category_breed"), V.BREEDS),
        S.flag(F.col("country_code").isin(V.POLAND_CODES)).alias("country_PL"),
        S.flag(F.col("city_name") == V.WARSAW).alias("city_Warsaw"),
        *races.surface_flags(),
    )


OUTCOMES = """COALESCE(finish_place = 1, FALSE) AS is_win, COALESCE(finish_place <= 3, FALSE) AS is_place,
    COALESCE(finish_place <= 5, FALSE) AS is_paid"""


@query("outcome_flags", f"SELECT race_record_id, {OUTCOMES} FROM race_records", "race_records")
def _(spark, sf):
    return view(spark, sf, "race_records").select("race_record_id", *S.outcome_flags(F.col("finish_place")))


AGE = f"EXTRACT(YEAR FROM {D}) - birth_year"


@query(
    "age_features",
    f"""SELECT horse_id, CAST({AGE} AS BIGINT) AS age_years,
               NOT ({AGE} BETWEEN 0 AND 20) AS is_age_outlier FROM horses""",
    "horses",
)
def _(spark, sf):
    return view(spark, sf, "horses").select("horse_id", *horses.age_columns(F.col("birth_year"), AS_OF))


@query(
    "safe_cast",
    """SELECT horse_id, race_year, race_type, TRY_CAST(prize_amounts AS DOUBLE) AS prize_amounts,
              TRY_CAST(prize_amounts AS BIGINT) AS prize_whole FROM horse_careers""",
    "horse_careers",
)
def _(spark, sf):
    text = F.col("prize_amounts")
    return view(spark, sf, "horse_careers").select(
        "horse_id",
        "race_year",
        "race_type",
        S.single_amount(text).alias("prize_amounts"),
        S.single_amount(text, "long").alias("prize_whole"),
    )


PAYOUT_SQL = ", ".join(
    f"TRY_CAST(REPLACE(NULLIF(REGEXP_EXTRACT(payments, '{c}\\s*([0-9]+,[0-9]+)', 1), ''), ',', '.') AS DOUBLE)"
    f" AS payout_{c.lower()}"
    for c in V.PAYOUT_CODES
)


@query("parse_payouts", f"SELECT race_id, {PAYOUT_SQL} FROM races", "races")
def _(spark, sf):
    return races.races_payouts(racing(spark, sf))


@query("races_payouts", f"SELECT race_id, {PAYOUT_SQL} FROM races", "races")
def _(spark, sf):
    return races.races_payouts(racing(spark, sf))


# ---- filters and joins over starts ------------------------------------------
@query(
    "as_of_filter",
    f"""SELECT race_id, CAST(CAST(race_date AS DATE) AS VARCHAR) AS day,
               CAST(race_date AS DATE) > CAST({D} - INTERVAL 1 YEAR AS DATE) AS in_last_year
        FROM races WHERE CAST(race_date AS DATE) <= {D}""",
    "races",
)
def _(spark, sf):
    at = F.col("race_date")
    return view(spark, sf, "races").where(up_to(at, AS_OF)).select(
        "race_id",
        F.to_date(at).cast("string").alias("day"),
        after(at, one_year_before(AS_OF)).alias("in_last_year"),
    )


@query(
    "records_asof",
    f"""WITH {STARTS} SELECT race_id, horse_id, jockey_id, trainer_id, finish_place,
        CAST(day AS VARCHAR) AS race_date, track_type, track_distance_m FROM starts""",
    RR,
)
def _(spark, sf):
    starts = asof_starts(racing(spark, sf), AS_OF)
    return text_of(starts.withColumn("race_date", F.to_date("race_date")), "race_date")


@query(
    "win_counts",
    f"""WITH {STARTS} SELECT jockey_id, COUNT(*) AS starts, COUNT(*) FILTER (WHERE finish_place = 1) AS wins,
        {dbl("1.0 * COUNT(*) FILTER (WHERE finish_place = 1) / COUNT(*)", "win_pct")}
        FROM starts WHERE jockey_id IS NOT NULL GROUP BY jockey_id""",
    RR,
)
def _(spark, sf):
    return starts_and_wins(asof_starts(racing(spark, sf), AS_OF), "jockey_id", "")


@query(
    "career_totals",
    """SELECT horse_id, COUNT(*) AS rows_all, COUNT(TRY_CAST(prize_amounts AS DOUBLE)) AS rows_priced,
              CAST(SUM(race_count) AS BIGINT) AS starts, MIN(race_year) AS first_year, MAX(race_year) AS last_year,
              AVG(race_won_count) AS avg_won
       FROM horse_careers GROUP BY horse_id""",
    "horse_careers",
)
def _(spark, sf):
    return horses.career_overview(view(spark, sf, "horse_careers"))


# ---- people -----------------------------------------------------------------
def person_sql(person: str, bands: dict) -> str:
    p = f"{person}_win_pct"
    win = "finish_place = 1"

    def rate(condition: str, name: str, default: bool = True) -> str:
        top = f"COUNT(*) FILTER (WHERE {win} AND {condition})"
        expr = f"1.0 * {top} / NULLIF(COUNT(*) FILTER (WHERE {condition}), 0)"
        return dbl(f"COALESCE({expr}, 0)" if default else expr, name)

    parts = [
        f"{person}_id",
        f"COUNT(*) AS {person}_total_starts",
        f"COUNT(*) FILTER (WHERE {win}) AS {person}_total_wins",
        rate("TRUE", p),
        rate(f"date_diff('day', day, {D}) <= 30", f"{p}_last_30d", False),
        rate(f"date_diff('day', day, {D}) <= 60", f"{p}_last_60d", False),
        *[rate(f"track_type = '{v}'", f"{p}_surface_{n.replace('_', '')}") for v, n in V.SURFACES.items()],
        *[rate(band_sql("track_distance_m", *e), f"{p}_dist_{n}") for n, e in bands.items()],
    ]
    return f"SELECT {', '.join(parts)} FROM starts WHERE {person}_id IS NOT NULL GROUP BY {person}_id"


JOCKEY_SQL = person_sql("jockey", V.JOCKEY_BANDS)
TRAINER_SQL = f"""SELECT p.*, COALESCE(s.n, 0) AS trainer_active_horses
    FROM ({person_sql("trainer", V.RACE_BANDS)}) p
    LEFT JOIN (SELECT trainer_id, COUNT(DISTINCT horse_id) AS n FROM horses GROUP BY trainer_id) s
    ON s.trainer_id = p.trainer_id"""


@query("jockeys", f"WITH {STARTS} {JOCKEY_SQL}", RR)
def _(spark, sf):
    return people.jockeys(racing(spark, sf), AS_OF)


@query("trainers", f"WITH {STARTS} {TRAINER_SQL}", f"{RR} horses")
def _(spark, sf):
    return people.trainers(racing(spark, sf), AS_OF)


@query(
    "stable_size",
    "SELECT trainer_id, COUNT(DISTINCT horse_id) AS trainer_active_horses FROM horses GROUP BY trainer_id",
    "horses",
)
def _(spark, sf):
    return people.stable_size(racing(spark, sf))


def _family_rates(prefix: str, families: dict[str, str]) -> str:
    return ", ".join(
        dbl(
            f"COALESCE(1.0 * COUNT(*) FILTER (WHERE finish_place = 1 AND {c}) / NULLIF(COUNT(*) FILTER (WHERE {c}), 0), 0)",
            f"{prefix}_{n}",
        )
        for n, c in families.items()
    )


SPECIAL = {
    **{f"surface_{n.replace('_', '')}": f"track_type = '{v}'" for v, n in V.SURFACES.items()},
    **{f"dist_{n}": band_sql("track_distance_m", *e) for n, e in V.RACE_BANDS.items()},
}


@query(
    "specialization_rates",
    f"WITH {STARTS} SELECT horse_id, {_family_rates('win_pct', SPECIAL)} FROM starts GROUP BY horse_id",
    RR,
)
def _(spark, sf):
    starts = asof_starts(racing(spark, sf), AS_OF)
    families = {
        **surface_families("win_pct_surface", F.col("track_type"), V.SURFACES),
        **band_families("win_pct_dist", F.col("track_distance_m"), V.RACE_BANDS),
    }
    return rates_by(starts, ["horse_id"], families=families, default=0.0)


@query(
    "recent_form",
    f"""WITH {STARTS} SELECT horse_id,
        COUNT(*) FILTER (WHERE day >= {D} - 30) AS starts_30d, COUNT(*) FILTER (WHERE day >= {D} - 60) AS starts_60d,
        COUNT(*) FILTER (WHERE day > CAST({D} - INTERVAL 1 YEAR AS DATE)) AS starts_1yr,
        {dbl(f"1.0 * COUNT(*) FILTER (WHERE finish_place = 1 AND day >= {D} - 30) / NULLIF(COUNT(*) FILTER (WHERE day >= {D} - 30), 0)", "win_pct_30d")}
        FROM starts GROUP BY horse_id""",
    RR,
)
def _(spark, sf):
    starts = asof_starts(racing(spark, sf), AS_OF)
    day, in30 = F.col("race_date"), people.within(30, AS_OF)
    return rates_by(
        starts,
        ["horse_id"],
        {
            "starts_30d": F.count_if(in30),
            "starts_60d": F.count_if(people.within(60, AS_OF)),
            "starts_1yr": F.count_if(after(day, one_year_before(AS_OF))),
            "win_pct_30d": share(S.is_win(), in30),
        },
    )


# ---- horses -----------------------------------------------------------------
HORSES_BASE = f"""SELECT horse_id, CAST({AGE} AS BIGINT) AS age_years,
    NOT ({AGE} BETWEEN 0 AND 20) AS is_age_outlier, """ + ", ".join(
    [flag_sql(f"horse_sex = '{v}'", n) for v, n in V.SEXES.items()]
    + [flag_sql(f"breed = '{v}'", n) for v, n in V.BREEDS.items()]
    + [flag_sql(f"color_name_pl = '{c}'", f"color_{c}") for c in V.COLORS]
) + " FROM horses"


@query("horses_base", HORSES_BASE, "horses")
def _(spark, sf):
    return horses.horses_base(racing(spark, sf), AS_OF)


HORSES_CAREER = f"""SELECT horse_id, CAST(SUM(race_count) AS BIGINT) AS career_starts,
    CAST(SUM(race_won_count) AS BIGINT) AS career_wins,
    {dbl("1.0 * SUM(race_won_count) / NULLIF(SUM(race_count), 0)", "career_win_pct")},
    {dbl("SUM(TRY_CAST(prize_amounts AS DOUBLE))", "total_earnings")},
    {dbl("SUM(TRY_CAST(prize_amounts AS DOUBLE)) / NULLIF(SUM(race_count), 0)", "earnings_per_start")}
    FROM horse_careers WHERE race_year <= EXTRACT(YEAR FROM {D}) GROUP BY horse_id"""


@query("horses_career", HORSES_CAREER, "horse_careers")
def _(spark, sf):
    return horses.horses_career(racing(spark, sf), AS_OF)


Y = f"EXTRACT(YEAR FROM {D})"
HORSES_RECENT = f"""
    SELECT h.horse_id, CAST(COALESCE(l.n, 0) AS BIGINT) AS rolling_race_count_last_3yrs,
        CAST(COALESCE(l.w, 0) AS BIGINT) AS rolling_win_count_last_3yrs,
        {dbl("COALESCE(1.0 * l.w / NULLIF(l.n, 0), 0)", "rolling_win_pct_last_3yrs")},
        CAST(COALESCE(c.n, 0) AS BIGINT) AS race_count_current_year,
        CAST(COALESCE(c.w, 0) AS BIGINT) AS win_count_current_year,
        {dbl("COALESCE(1.0 * c.w / NULLIF(c.n, 0), 0)", "win_pct_current_year")},
        {dbl("COALESCE(1.0 * c.w / NULLIF(c.n, 0), 0) - COALESCE(1.0 * l.w / NULLIF(l.n, 0), 0)", "current_vs_last3yrs_win_pct")},
        date_diff('day', f.last_day, {D}) AS days_since_last_race
    FROM horses h
    LEFT JOIN (SELECT horse_id, SUM(n) AS n, SUM(w) AS w FROM annual
               WHERE race_year >= {Y} - 2 GROUP BY horse_id) l ON l.horse_id = h.horse_id
    LEFT JOIN (SELECT horse_id, n, w FROM annual WHERE race_year = {Y}) c ON c.horse_id = h.horse_id
    LEFT JOIN (SELECT horse_id, MAX(day) AS last_day FROM starts GROUP BY horse_id) f ON f.horse_id = h.horse_id"""
ANNUAL = f"""annual AS (SELECT horse_id, race_year, SUM(race_count) AS n, SUM(race_won_count) AS w
    FROM horse_careers WHERE race_year <= {Y} GROUP BY horse_id, race_year)"""


@query("horses_recent", f"WITH {STARTS}, {ANNUAL} {HORSES_RECENT}", f"{RR} horses horse_careers")
def _(spark, sf):
    return horses.horses_recent(racing(spark, sf), AS_OF)


@query(
    "rolling_3yr",
    f"""WITH {ANNUAL} SELECT horse_id, CAST(SUM(n) AS BIGINT) AS races, CAST(SUM(w) AS BIGINT) AS wins,
        {dbl("1.0 * SUM(w) / NULLIF(SUM(n), 0)", "win_pct")}
        FROM annual WHERE race_year BETWEEN {Y} - 2 AND {Y} GROUP BY horse_id""",
    "horse_careers",
)
def _(spark, sf):
    sums = horses.career_sums(racing(spark, sf), AS_OF).where(F.col("_races3").isNotNull())
    return sums.select(
        "horse_id",
        F.col("_races3").alias("races"),
        F.col("_wins3").alias("wins"),
        S.ratio(F.col("_wins3"), F.col("_races3")).alias("win_pct"),
    )


@query(
    "days_since_last",
    f"""WITH {STARTS} SELECT horse_id, date_diff('day', MAX(day), {D}) AS days_since_last_race
        FROM starts GROUP BY horse_id""",
    RR,
)
def _(spark, sf):
    form = horses.horse_form(asof_starts(racing(spark, sf), AS_OF), AS_OF)
    days = F.datediff(F.lit(AS_OF), F.to_date("last_date")).cast("long")
    return form.select("horse_id", days.alias("days_since_last_race"))


def role_sql() -> tuple[str, str]:
    """(joins, columns) that look up sire, dam, trainer and breeder counts."""
    counts = "COUNT(*) AS n, COUNT(*) FILTER (WHERE finish_place = 1) AS w"
    parents = "horse_id IN (SELECT {c} FROM horses WHERE {c} IS NOT NULL)"
    sources = {
        "sire": f"SELECT horse_id AS id, {counts} FROM starts WHERE {parents.format(c='father_id')} GROUP BY 1",
        "dam": f"SELECT horse_id AS id, {counts} FROM starts WHERE {parents.format(c='mother_id')} GROUP BY 1",
        "trainer": f"SELECT trainer_id AS id, {counts} FROM starts WHERE trainer_id IS NOT NULL GROUP BY 1",
        "breeder": f"""SELECT b.breeder_id AS id, {counts} FROM starts s JOIN horses b ON b.horse_id = s.horse_id
                       WHERE b.breeder_id IS NOT NULL GROUP BY 1""",
    }
    joins, columns = "", []
    for role, sql in sources.items():
        joins += f" LEFT JOIN ({sql}) {role} ON {role}.id = h.{horses.ROLES[role]}"
        columns += [
            f"COALESCE({role}.n, 0) AS {role}_starts",
            f"COALESCE({role}.w, 0) AS {role}_wins",
            dbl(f"COALESCE(1.0 * {role}.w / {role}.n, 0)", f"{role}_win_pct"),
        ]
    return joins, ", ".join(columns)


ROLE_JOINS, ROLE_COLUMNS = role_sql()
HORSES_PERF = f"SELECT h.horse_id, {ROLE_COLUMNS} FROM horses h {ROLE_JOINS}"


@query("horses_perf", f"WITH {STARTS} {HORSES_PERF}", f"{RR} horses")
def _(spark, sf):
    return horses.horses_perf(racing(spark, sf), AS_OF)


@query(
    "pedigree_perf",
    f"WITH {STARTS}, perf AS ({HORSES_PERF}) SELECT horse_id, sire_starts, sire_wins, dam_starts, dam_wins FROM perf",
    f"{RR} horses",
)
def _(spark, sf):
    perf = horses.horses_perf(racing(spark, sf), AS_OF)
    return perf.select("horse_id", "sire_starts", "sire_wins", "dam_starts", "dam_wins")


@query(
    "semi_parent",
    f"""WITH {STARTS} SELECT horse_id, COUNT(*) AS starts, COUNT(*) FILTER (WHERE finish_place = 1) AS wins
        FROM starts WHERE horse_id IN (SELECT father_id FROM horses WHERE father_id IS NOT NULL)
        GROUP BY horse_id""",
    f"{RR} horses",
)
def _(spark, sf):
    return horses.parent_runs(racing(spark, sf), AS_OF)


@query(
    "sire_progeny",
    f"""SELECT h.father_id, COUNT(*) AS race_count, COUNT(*) FILTER (WHERE r.finish_place = 1) AS win_count,
        {dbl("1.0 * COUNT(*) FILTER (WHERE r.finish_place = 1) / COUNT(*)", "win_pct")}
        FROM race_records r JOIN horses h ON h.horse_id = r.horse_id
        WHERE h.father_id IS NOT NULL GROUP BY h.father_id""",
    "race_records horses",
)
def _(spark, sf):
    return horses.sire_progeny(racing(spark, sf))


HORSE_FEATURES = f"""
    SELECT b.*, p.* EXCLUDE (horse_id), c.* EXCLUDE (horse_id), r.* EXCLUDE (horse_id)
    FROM hb b JOIN hp p ON p.horse_id = b.horse_id JOIN hc c ON c.horse_id = b.horse_id
    JOIN hr r ON r.horse_id = b.horse_id"""
HORSE_CTES = f"""{STARTS}, {ANNUAL}, hb AS ({HORSES_BASE}), hp AS ({HORSES_PERF}),
    hc AS ({HORSES_CAREER}), hr AS ({HORSES_RECENT})"""


@query("horse_features", f"WITH {HORSE_CTES} {HORSE_FEATURES}", f"{RR} horses horse_careers")
def _(spark, sf):
    t = racing(spark, sf)
    return horses.horse_features(t, AS_OF, common=horses.shared_counts(t, AS_OF, stored=("form",)))


BREEDERS_SQL = f"""
    SELECT a.*, COALESCE(y.n, 0) AS breeder_progeny_race_count_last_1yr,
        COALESCE(y.w, 0) AS breeder_progeny_win_count_last_1yr,
        {dbl("COALESCE(1.0 * y.w / y.n, 0)", "breeder_win_pct_progeny_last_1yr")}
    FROM (SELECT h.breeder_id, COUNT(*) AS breeder_progeny_count,
              CAST(SUM(c.career_starts) AS BIGINT) AS breeder_total_progeny_race_count,
              CAST(SUM(c.career_wins) AS BIGINT) AS breeder_total_progeny_win_count,
              {rnd("AVG(c.career_wins / NULLIF(CAST(c.career_starts AS DOUBLE), 0))", "breeder_avg_win_pct")},
              {rnd("AVG(c.total_earnings)", "breeder_avg_earnings")}
          FROM horses h JOIN hc c ON c.horse_id = h.horse_id WHERE h.breeder_id IS NOT NULL
          GROUP BY h.breeder_id) a
    LEFT JOIN (SELECT h.breeder_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE s.finish_place = 1) AS w
          FROM starts s JOIN horses h ON h.horse_id = s.horse_id
          WHERE h.breeder_id IS NOT NULL AND s.day > CAST({D} - INTERVAL 1 YEAR AS DATE)
          GROUP BY h.breeder_id) y ON y.breeder_id = a.breeder_id"""


@query("breeders", f"WITH {STARTS}, hc AS ({HORSES_CAREER}) {BREEDERS_SQL}", f"{RR} horses horse_careers", MEANS)
def _(spark, sf):
    return people.breeders(racing(spark, sf), AS_OF)


@query(
    "breeder_progeny",
    f"""WITH hc AS ({HORSES_CAREER})
        SELECT h.breeder_id, COUNT(h.horse_id) AS progeny, CAST(SUM(c.career_starts) AS BIGINT) AS starts,
               {dbl("AVG(c.total_earnings)", "avg_earnings")}
        FROM horses h JOIN hc c ON c.horse_id = h.horse_id WHERE h.breeder_id IS NOT NULL GROUP BY h.breeder_id""",
    "horses horse_careers",
)
def _(spark, sf):
    return people.breeder_progeny(racing(spark, sf), AS_OF)


# ---- races and starters -----------------------------------------------------
RACES_BASE = f"""SELECT race_id, track_distance_m AS distance_m, {DIST_FLAGS}, temperature_c, {weather_sql(False)},
    {STYLE_SQL} AS style_ease_score, {RACE_ONEHOT} FROM races"""


@query("races_base", RACES_BASE, "races")
def _(spark, sf):
    return races.races_base(racing(spark, sf))


CONTEXT = """SELECT race_record_id, race_id, horse_id, COUNT(*) OVER (PARTITION BY race_id) AS field_size, start_order,
    jockey_weight_kg, quantile_cont(jockey_weight_kg, 0.5) OVER (PARTITION BY race_id) AS median_jockey_weight_kg
    FROM race_records"""


@query(
    "records_context",
    f"""WITH c AS ({CONTEXT}) SELECT race_id, horse_id, field_size, start_order, jockey_weight_kg,
        median_jockey_weight_kg, jockey_weight_kg - median_jockey_weight_kg AS weight_diff FROM c""",
    "race_records",
)
def _(spark, sf):
    return races.records_context(racing(spark, sf))


@query(
    "field_size",
    "SELECT race_record_id, race_id, COUNT(*) OVER (PARTITION BY race_id) AS field_size FROM race_records",
    "race_records",
)
def _(spark, sf):
    t = racing(spark, sf)
    return t.race_records.select("race_record_id", "race_id").join(races.field_size(t), "race_id")


@query(
    "weight_diff",
    f"""WITH c AS ({CONTEXT}) SELECT race_id, horse_id, race_record_id,
        jockey_weight_kg - median_jockey_weight_kg AS weight_diff FROM c""",
    "race_records",
)
def _(spark, sf):
    t = racing(spark, sf)
    median = races.race_context(t).select("race_id", "median_jockey_weight_kg")
    diff = F.col("jockey_weight_kg") - F.col("median_jockey_weight_kg")
    return t.race_records.join(median, "race_id").select(
        "race_id", "horse_id", "race_record_id", diff.alias("weight_diff")
    )


@query("records_outcomes", f"SELECT race_id, horse_id, finish_place, {OUTCOMES} FROM race_records", "race_records")
def _(spark, sf):
    return races.records_outcomes(racing(spark, sf))


@query(
    "dimension_enrich",
    """SELECT r.race_record_id, r.race_id, h.horse_name, j.last_name AS jockey_last_name,
              t.last_name AS trainer_last_name, b.name AS breeder_name
       FROM race_records r LEFT JOIN horses h ON h.horse_id = r.horse_id
       LEFT JOIN jockeys j ON j.jockey_id = r.jockey_id LEFT JOIN trainers t ON t.trainer_id = r.trainer_id
       LEFT JOIN breeders b ON b.breeder_id = h.breeder_id""",
    "race_records horses jockeys trainers breeders",
)
def _(spark, sf):
    return names.starter_names(racing(spark, sf))


STATIC = RACES_BASE
RACE_FEATURES = f"""
    SELECT r.race_id, r.horse_id, r.jockey_id, r.trainer_id, h.age_years AS horse_age_years,
        h.is_stallion, h.is_mare, h.is_gelding, {", ".join("h." + c for c in V.BREEDS.values())},
        s.* EXCLUDE (race_id, {", ".join(V.BREEDS.values())}),
        {", ".join(f"s.{c} AS race_{c}" for c in V.BREEDS.values())},
        c.field_size, r.start_order, r.jockey_weight_kg,
        r.jockey_weight_kg - c.median_jockey_weight_kg AS weight_diff,
        r.finish_place, r.finish_place = 1 AS is_win, r.finish_place <= 3 AS is_place, r.finish_place <= 5 AS is_paid,
        j.* EXCLUDE (jockey_id, jockey_win_pct_last_30d, jockey_win_pct_last_60d),
        COALESCE(j.jockey_win_pct_last_30d, 0) AS jockey_win_pct_last_30d,
        COALESCE(j.jockey_win_pct_last_60d, 0) AS jockey_win_pct_last_60d,
        t.* EXCLUDE (trainer_id, trainer_win_pct_last_30d, trainer_win_pct_last_60d),
        COALESCE(t.trainer_win_pct_last_30d, 0) AS trainer_win_pct_last_30d,
        COALESCE(t.trainer_win_pct_last_60d, 0) AS trainer_win_pct_last_60d,
        b.* EXCLUDE (breeder_id)
    FROM race_records r
    JOIN hf h ON h.horse_id = r.horse_id
    LEFT JOIN js j ON j.jockey_id = r.jockey_id
    LEFT JOIN ts t ON t.trainer_id = r.trainer_id
    LEFT JOIN st s ON s.race_id = r.race_id
    LEFT JOIN cx c ON c.race_record_id = r.race_record_id AND c.race_id = r.race_id AND c.horse_id = r.horse_id
    LEFT JOIN horses m ON m.horse_id = r.horse_id
    LEFT JOIN bs b ON b.breeder_id = m.breeder_id
    WHERE r.start_order IS NOT NULL AND r.finish_place IS NOT NULL"""
FEATURE_CTES = f"""{HORSE_CTES}, hf AS ({HORSE_FEATURES}), js AS ({JOCKEY_SQL}), ts AS ({TRAINER_SQL}),
    bs AS ({BREEDERS_SQL}), st AS ({STATIC}), cx AS ({CONTEXT})"""


@query("race_features", f"WITH {FEATURE_CTES} {RACE_FEATURES}", f"{RR} horses horse_careers", MEANS)
def _(spark, sf):
    t = racing(spark, sf)
    # Jockeys, trainers and breeders all read the starts: join them once.
    starts = materialize(asof_starts(t, AS_OF), "starts")
    common = horses.shared_counts(t, AS_OF, starts, stored=("form", "careers"))
    return assembly.race_features(t, AS_OF, starts, common=common)


# ---- upcoming starters ------------------------------------------------------
UPCOMING = f"""
SELECT a.race_number, r.horse_id, r.jockey_id, r.trainer_id, r.start_order, r.jockey_weight_kg,
       a.track_distance_m AS distance_m, a.temperature_c
FROM race_records r JOIN races a ON a.race_id = r.race_id WHERE CAST(a.race_date AS DATE) > {D}"""


def upcoming(tables):
    """Starters of the races after the cut-off date."""
    later = tables.races.where(after(F.col("race_date"), AS_OF)).select(
        "race_id", "race_number", F.col("track_distance_m").alias("distance_m"), "temperature_c"
    )
    runs = tables.race_records.select(
        "race_id", "horse_id", "jockey_id", "trainer_id", "start_order", "jockey_weight_kg"
    )
    return runs.join(later, "race_id").drop("race_id")


@query(
    "score_input",
    f"""WITH {FEATURE_CTES}, up AS ({UPCOMING})
        SELECT u.*, h.* EXCLUDE (horse_id, trainer_win_pct), h.trainer_win_pct AS horse_trainer_win_pct,
               h.age_years AS horse_age_years, j.* EXCLUDE (jockey_id),
               t.* EXCLUDE (trainer_id), b.* EXCLUDE (breeder_id)
        FROM up u LEFT JOIN hf h ON h.horse_id = u.horse_id LEFT JOIN js j ON j.jockey_id = u.jockey_id
        LEFT JOIN ts t ON t.trainer_id = u.trainer_id
        LEFT JOIN horses m ON m.horse_id = h.horse_id LEFT JOIN bs b ON b.breeder_id = m.breeder_id""",
    f"{RR} horses horse_careers",
    MEANS,
)
def _(spark, sf):
    t = racing(spark, sf)
    starts = materialize(asof_starts(t, AS_OF), "starts")
    common = horses.shared_counts(t, AS_OF, starts, stored=("form", "careers"))
    return assembly.assemble_new_races(t, upcoming(t), AS_OF, starts, common)
