"""Table functions with a date against the Python functions, and their plans."""

import datetime as dt
import math

import pytest

from paddock.plans import horses, people
from paddock.sql_functions import NAMES, register_functions

DAYS = ("1996-02-29", "1998-01-01", "2001-06-30")


@pytest.fixture(scope="module")
def functions(spark, tables):
    register_functions(spark, tables)


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def close(x, y):
    return x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-12))


def plan(name):
    return getattr(horses if name.startswith("horse") else people, name)


@pytest.mark.parametrize("name", NAMES)
def test_lateral_call(spark, tables, functions, name):
    days = ", ".join(f"DATE '{d}'" for d in DAYS)
    got = spark.sql(f"SELECT d.day, f.* FROM (SELECT explode(array({days})) AS day) d, LATERAL {name}(d.day) f")
    expected = {d: plan(name)(tables, d) for d in DAYS}
    assert [(f.name, f.dataType) for f in got.schema.fields[1:]] == [(f.name, f.dataType) for f in expected[DAYS[0]].schema.fields]
    want = sorted(((dt.date.fromisoformat(d), *r) for d, df in expected.items() for r in df.collect()), key=repr)
    rows = sorted_rows(got)
    assert len(rows) == len(want) and all(close(x, y) for a, b in zip(rows, want) for x, y in zip(a, b))


def test_constant_date_is_pushed_down(spark, tables, functions, tmp_path):
    """The date of a call is a filter of the scan, and no correlation is left."""
    races, records = f"{tmp_path}/races", f"{tmp_path}/records"
    tables.races.write.parquet(races)
    tables.race_records.write.parquet(records)
    register_functions(spark, tables, {"races": f"parquet.`{races}`", "race_records": f"parquet.`{records}`"})
    df = spark.sql("SELECT * FROM jockeys(DATE '1998-01-01')")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "1998-01-02" in text.split("PushedFilters", 1)[1] and "NestedLoop" not in text
    assert sorted_rows(df) == sorted_rows(people.jockeys(tables, "1998-01-01"))
    register_functions(spark, tables)


def test_functions_that_outlive_the_session(spark, tables):
    base = {n: f"default.stored_{n}" for n in ("races", "race_records", "horses", "horse_careers")}
    for name, stored in base.items():
        getattr(tables, name).write.mode("overwrite").saveAsTable(stored)
    try:
        with pytest.raises(ValueError):
            register_functions(spark, tables, {"races": "default.stored_races"}, temporary=False)
        spark.sql("DROP TEMPORARY FUNCTION IF EXISTS trainers")
        register_functions(spark, tables, base, temporary=False)
        assert sorted_rows(spark.sql("SELECT * FROM trainers('1998-01-01')")) == sorted_rows(people.trainers(tables, "1998-01-01"))
    finally:
        for name in NAMES:
            spark.sql(f"DROP FUNCTION IF EXISTS default.{name}")
        for stored in base.values():
            spark.sql(f"DROP TABLE IF EXISTS {stored}")
