"""Features of several dates: SQL table functions and stored day counters."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.plans import day_counters, horses
from paddock.plans.day_counters import DayCounters, touched_days
from paddock.plans.starts import after, up_to
from paddock.session import scratch_path
from paddock.sql_functions import NAMES, register_functions
from suite.feature_queries import D, MEANS
from suite.fixtures import racing
from suite.registry import ORACLES, query

DAYS = ("1996-02-29", "1998-01-01", "2001-06-30")
DATES = "SELECT explode(array({})) AS model_date".format(", ".join(f"DATE '{d}'" for d in DAYS))


def for_each_day(name: str) -> str:
    """The SQL that the Python function is checked against, once for each date."""
    return "\nUNION ALL\n".join(f"SELECT '{d}' AS model_date, * FROM ({ORACLES[name].replace(D, f"DATE '{d}'")}) AS q{i}" for i, d in enumerate(DAYS))


def add(name: str) -> None:
    def lateral(spark, sf):
        register_functions(spark, racing(spark, sf))
        return spark.sql(f"SELECT CAST(d.model_date AS STRING) AS model_date, f.* FROM ({DATES}) d, LATERAL {name}(d.model_date) f")

    lateral.__doc__ = f"{name} as a SQL function, laterally over a table of dates."
    query(f"tvf_{name}", for_each_day(name), rounds=MEANS if name == "breeders" else "")(lateral)


for _name in NAMES:
    add(_name)


# ---- stored day counters ----------------------------------------------------
BUILT: dict[tuple, DayCounters] = {}
SPLIT = "2000-12-31"


def counters(spark, sf: str) -> DayCounters:
    """Counters built once for a session and folder: all races up to a day, and then
    the later days as a feed would add them."""
    at = (spark.sparkContext.applicationId, sf)
    if at not in BUILT:
        t = racing(spark, sf)
        early = replace(t, races=t.races.where(up_to(F.col("race_date"), SPLIT)))
        found = DayCounters(spark, scratch_path(spark, "counters"))
        found.rebuild(early)
        later = t.races.where(after(F.col("race_date"), SPLIT))
        found.extend(t, touched_days(t.races, t.race_records.join(later, "race_id", "left_semi")))
        BUILT[at] = found
    return BUILT[at]


def counted(name: str, features, rounds: str = "") -> None:
    def each_day(spark, sf):
        t, stored = racing(spark, sf), counters(spark, sf)
        return reduce(DataFrame.unionByName, [features(stored, t, d).withColumn("model_date", F.lit(d)) for d in DAYS])

    each_day.__doc__ = f"{name} of three dates from stored counters, without the starts."
    query(f"counted_{name}", for_each_day(name), rounds=rounds)(each_day)


counted("jockeys", lambda stored, t, d: day_counters.jockeys(stored, d))
counted("trainers", lambda stored, t, d: day_counters.trainers(stored, t, d))
counted("breeders", lambda stored, t, d: day_counters.breeders(stored, t, d), MEANS)
counted("horse_features", lambda stored, t, d: horses.horse_features(t, d, common=day_counters.shared_counts(stored, t, d)))
