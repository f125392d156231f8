"""Table functions with a date for SQL users: ``SELECT * FROM jockeys(DATE '2025-07-31')``.

Each is a SQL function whose body the optimizer puts in place of its call, so a constant
date reaches the file scans as a filter. Called laterally over a table of dates,
``FROM dates d, LATERAL jockeys(d.day) f``, the body is planned once for all of them:
starts meet the dates (which are broadcast when small) and are grouped by date as well.

The results are those of the Python functions of the same name.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from paddock.functions import vocab as V
from paddock.plans import horses, people
from paddock.schema import RacingTables

WIN = "finish_place = 1"
NAMES = ("horses_base", "horses_career", "horses_recent", "horses_perf", "horse_features", "jockeys", "trainers", "breeders")


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ratio(top: str, bottom: str) -> str:
    return f"try_divide(CAST({top} AS DOUBLE), CAST({bottom} AS DOUBLE))"


def share(condition: str) -> str:
    return ratio(f"count_if({WIN} AND {condition})", f"count_if({condition})")


def band(low, high) -> str:
    if low is None:
        return f"track_distance_m <= {high}"
    return f"track_distance_m >= {low}" if high is None else f"track_distance_m BETWEEN {low} AND {high}"


def one_hot(column: str, names: dict[str, str]) -> list[str]:
    return [f"coalesce({column} = {text(label)}, FALSE) AS {name}" for label, name in names.items()]


class Bodies:
    """The queries behind the functions; ``{fn}.model_date`` is the date of function
    fn, and ``base`` the name of each base table."""

    def __init__(self, base: dict[str, str]):
        self.base = base

    def starts(self, fn: str) -> str:
        """Starts up to the date, which is a column of them (``day``): aggregates may
        not mix columns with the argument of the function."""
        return f"""SELECT r.horse_id, r.jockey_id, r.trainer_id, r.finish_place, a.race_date, a.track_type, a.track_distance_m,
                   {fn}.model_date AS day
            FROM {self.base["race_records"]} r JOIN {self.base["races"]} a ON a.race_id = r.race_id
            WHERE a.race_date < date_add({fn}.model_date, 1)"""

    def careers(self, fn: str) -> str:
        races, wins = "try_cast(race_count AS BIGINT)", "try_cast(race_won_count AS BIGINT)"
        return f"""SELECT horse_id, sum({races}) AS career_starts, sum({wins}) AS career_wins,
                   sum(try_cast(prize_amounts AS DOUBLE)) AS total_earnings,
                   sum(CASE WHEN race_year >= year - 2 THEN {races} END) AS races3, sum(CASE WHEN race_year >= year - 2 THEN {wins} END) AS wins3,
                   sum(CASE WHEN race_year = year THEN {races} END) AS races1, sum(CASE WHEN race_year = year THEN {wins} END) AS wins1
            FROM (SELECT *, year({fn}.model_date) AS year FROM {self.base["horse_careers"]} WHERE race_year <= year({fn}.model_date))
            GROUP BY horse_id"""

    def pairs(self, fn: str) -> str:
        """Counts of each horse with each trainer, which roll up to both."""
        recent = "race_date >= date_add(add_months(day, -12), 1)"
        return f"""SELECT horse_id, trainer_id, count(*) AS starts, count_if({WIN}) AS wins, max(race_date) AS last_date,
                   count_if({recent}) AS starts_1yr, count_if({recent} AND {WIN}) AS wins_1yr
            FROM ({self.starts(fn)}) GROUP BY horse_id, trainer_id"""

    def form(self, fn: str, key: str = "horse_id") -> str:
        sums = ", ".join(f"sum({c}) AS {c}" for c in ("starts", "wins", "starts_1yr", "wins_1yr"))
        return f"SELECT {key}, {sums}, max(last_date) AS last_date FROM ({self.pairs(fn)}) GROUP BY {key}"

    def horses_base(self) -> str:
        age = "CAST(year(horses_base.model_date) AS BIGINT) - birth_year"
        coded = one_hot("horse_sex", V.SEXES) + one_hot("breed", V.BREEDS) + one_hot("color_name_pl", {c: f"color_{c}" for c in V.COLORS})
        return f"SELECT horse_id, {age} AS age_years, {age} < 0 OR {age} > 20 AS is_age_outlier, {', '.join(coded)} FROM {self.base['horses']}"

    def horses_career(self) -> str:
        return f"""SELECT horse_id, career_starts, career_wins, {ratio("career_wins", "career_starts")} AS career_win_pct, total_earnings,
                   {ratio("total_earnings", "career_starts")} AS earnings_per_start
            FROM ({self.careers("horses_career")})"""

    def merged(self, key: str, *parts: tuple[str, tuple[str, ...]]) -> str:
        """Parts (query, columns) side by side, one row for each key; a column that a
        part lacks is null. The date may not be used on the optional side of an outer
        join, so this is a union that is grouped."""
        names = list(dict.fromkeys(c for _, columns in parts for c in columns))
        each = [f"SELECT {key}, {', '.join(c if c in columns else f'NULL AS {c}' for c in names)} FROM ({query})" for query, columns in parts]
        return f"SELECT {key}, {', '.join(f'max({c}) AS {c}' for c in names)} FROM ({' UNION ALL '.join(each)}) GROUP BY {key}"

    def recent_columns(self) -> str:
        """Columns of careers (``races3`` and so on), ``last_date`` and ``model_day``."""
        pct3, pct1 = (f"coalesce({ratio(f'wins{n}', f'races{n}')}, 0D)" for n in (3, 1))
        return f"""coalesce(races3, 0) AS rolling_race_count_last_3yrs, coalesce(wins3, 0) AS rolling_win_count_last_3yrs,
                   {pct3} AS rolling_win_pct_last_3yrs, coalesce(races1, 0) AS race_count_current_year,
                   coalesce(wins1, 0) AS win_count_current_year, {pct1} AS win_pct_current_year,
                   {pct1} - {pct3} AS current_vs_last3yrs_win_pct,
                   CAST(datediff(model_day, to_date(last_date)) AS BIGINT) AS days_since_last_race"""

    def horses_recent(self) -> str:
        fn = "horses_recent"
        known = f"SELECT horse_id, {fn}.model_date AS model_day FROM {self.base['horses']}"
        sums = ("races3", "wins3", "races1", "wins1")
        rows = self.merged("horse_id", (known, ("model_day",)), (self.careers(fn), sums), (self.form(fn), ("last_date",)))
        return f"SELECT horse_id, {self.recent_columns()} FROM ({rows}) WHERE model_day IS NOT NULL"

    def counted(self, fn: str) -> str:
        """Starts, wins and the last date of every horse, trainer and breeder from one
        pass over the pairs. A horse counts for each breeder it is listed with."""
        bred = f"SELECT horse_id, collect_list(breeder_id) AS breeders FROM {self.base['horses']} GROUP BY horse_id"
        ids = """concat(array(struct('horse' AS kind, p.horse_id AS id), struct('trainer' AS kind, p.trainer_id AS id)),
            transform(coalesce(b.breeders, array()), x -> struct('breeder' AS kind, x AS id)))"""
        each = f"SELECT inline({ids}), p.starts, p.wins, p.last_date FROM ({self.pairs(fn)}) p LEFT JOIN ({bred}) b ON b.horse_id = p.horse_id"
        return f"SELECT kind, id, sum(starts) AS starts, sum(wins) AS wins, max(last_date) AS last_date FROM ({each}) GROUP BY kind, id"

    def roles(self, fn: str) -> str:
        """Counts of each horse's sire, dam, trainer and breeder, and its own last date."""
        base, columns = self.base["horses"], []
        roles = {"sire": ("horse", "father_id"), "dam": ("horse", "mother_id"), "trainer": ("trainer", "trainer_id"), "breeder": ("breeder", "breeder_id")}
        named = {**roles, "self": ("horse", "horse_id")}
        links = ", ".join(f"struct('{role}' AS role, '{kind}' AS kind, {column} AS id)" for role, (kind, column) in named.items())
        found = f"""SELECT l.horse_id, l.role, c.starts, c.wins, c.last_date FROM (SELECT horse_id, inline(array({links})) FROM {base}) l
            JOIN ({self.counted(fn)}) c ON c.kind = l.kind AND c.id = l.id"""
        every = f"SELECT horse_id, '' AS role, 0 AS starts, 0 AS wins, NULL AS last_date FROM {base}"
        for role in roles:
            starts, wins = (f"sum(CASE WHEN role = '{role}' THEN {c} ELSE 0 END)" for c in ("starts", "wins"))
            columns += [f"{starts} AS {role}_starts", f"{wins} AS {role}_wins", f"coalesce({ratio(wins, starts)}, 0D) AS {role}_win_pct"]
        own = "max(CASE WHEN role = 'self' THEN last_date END) AS last_date"
        return f"SELECT horse_id, {', '.join(columns)}, {own} FROM ({every} UNION ALL {found}) GROUP BY horse_id"

    def horses_perf(self) -> str:
        return f"SELECT * EXCEPT (last_date) FROM ({self.roles('horses_perf')})"

    def horse_features(self) -> str:
        """Its parts by their own columns, so that starts and careers are counted once."""
        fn = "horse_features"
        day = f"{fn}.model_date"
        career = f"""SELECT *, {ratio("career_wins", "career_starts")} AS career_win_pct,
                   {ratio("total_earnings", "career_starts")} AS earnings_per_start, {day} AS model_day FROM ({self.careers(fn)})"""
        return f"""SELECT *, {self.recent_columns()}
            FROM horses_base({day}) JOIN ({self.roles(fn)}) USING (horse_id) JOIN ({career}) USING (horse_id)"""

    def person(self, fn: str, person: str, bands: dict) -> str:
        pct = f"{person}_win_pct"
        rates = [f"{share(f'race_date >= date_sub(day, {days})')} AS {pct}_last_{days}d" for days in (30, 60)]
        families = {f"{pct}_surface_{n.replace('_', '')}": f"track_type = {text(label)}" for label, n in V.SURFACES.items()}
        families |= {f"{pct}_dist_{n}": band(*edges) for n, edges in bands.items()}
        rates += [f"coalesce({share(condition)}, 0D) AS {name}" for name, condition in families.items()]
        return f"""SELECT {person}_id, count(*) AS {person}_total_starts, count_if({WIN}) AS {person}_total_wins,
                   {ratio(f"count_if({WIN})", "count(*)")} AS {pct}, {", ".join(rates)}
            FROM ({self.starts(fn)}) WHERE {person}_id IS NOT NULL GROUP BY {person}_id"""

    def jockeys(self) -> str:
        return self.person("jockeys", "jockey", V.JOCKEY_BANDS)

    def trainers(self) -> str:
        stable = f"SELECT trainer_id, count(DISTINCT horse_id) AS n FROM {self.base['horses']} GROUP BY trainer_id"
        return f"""SELECT p.*, coalesce(s.n, 0) AS trainer_active_horses FROM ({self.person("trainers", "trainer", V.RACE_BANDS)}) p
            LEFT JOIN ({stable}) s ON s.trainer_id = p.trainer_id"""

    def breeders(self) -> str:
        fn, career = "breeders", ("career_starts", "career_wins", "total_earnings", "ran")
        careers = f"SELECT *, 1 AS ran FROM ({self.careers(fn)})"
        rows = self.merged("horse_id", (careers, career), (self.form(fn), ("starts_1yr", "wins_1yr")))
        return f"""SELECT * FROM (
            SELECT h.breeder_id, count(p.ran) AS breeder_progeny_count, sum(career_starts) AS breeder_total_progeny_race_count,
                   sum(career_wins) AS breeder_total_progeny_win_count, avg({ratio("career_wins", "career_starts")}) AS breeder_avg_win_pct,
                   avg(total_earnings) AS breeder_avg_earnings, coalesce(sum(starts_1yr), 0) AS breeder_progeny_race_count_last_1yr,
                   coalesce(sum(wins_1yr), 0) AS breeder_progeny_win_count_last_1yr,
                   coalesce({ratio("sum(wins_1yr)", "sum(starts_1yr)")}, 0D) AS breeder_win_pct_progeny_last_1yr
            FROM {self.base["horses"]} h JOIN ({rows}) p ON p.horse_id = h.horse_id
            WHERE h.breeder_id IS NOT NULL GROUP BY h.breeder_id) WHERE breeder_progeny_count > 0"""


def function_sql(name: str, tables: RacingTables, base: dict[str, str], temporary: bool = True) -> str:
    """The statement that creates one function; its columns are those of the Python
    function, which also gives their types."""
    plan = getattr(horses if name.startswith("horse") else people, name)
    fields = plan(tables, "2000-01-01").schema.fields
    columns = ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in fields)
    kind = "TEMPORARY FUNCTION" if temporary else "FUNCTION"
    chosen = ", ".join(f.name for f in fields)
    return f"CREATE OR REPLACE {kind} {name}(model_date DATE) RETURNS TABLE({columns})\nRETURN SELECT {chosen} FROM ({getattr(Bodies(base), name)()})"


def register_functions(spark: SparkSession, tables: RacingTables, base: dict[str, str] = None, temporary: bool = True) -> None:
    """Create the table functions over named base tables.

    ``base`` says under which name each base table is found (its own name otherwise);
    those without a name there become temporary views of ``tables``. Functions that
    are to outlive the session (``temporary=False``) need catalog tables for all.
    """
    names = {n: (base or {}).get(n) for n in ("races", "race_records", "horses", "horse_careers")}
    for name, known in names.items():
        if known is None:
            if not temporary:
                raise ValueError(f"a permanent function needs a catalog table for {name}")
            getattr(tables, name).createOrReplaceTempView(name)
            names[name] = name
    for name in NAMES:
        spark.sql(function_sql(name, tables, names, temporary))
