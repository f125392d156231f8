"""Where queries and their reference SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.session import tune
from suite.fixtures import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def rounded(df: DataFrame, names: tuple[str, ...], digits: int = 6) -> DataFrame:
    """Round the sums and means of fractions, whose last bits depend on the
    order of summation. Ratios of counts are compared exactly."""
    return df.withColumns({c: F.round(c, digits) for c in names}) if names else df


def query(name: str, sql: str = None, views: str = "", rounds: str = "") -> Callable[[Query], Query]:
    """Register a query; ``views`` names the derived views its SQL reads."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(tune(spark), sf_dir), tuple(rounds.split()))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql, *views.split()) if views else sql.strip()
        return fn

    return add


def sql_list(words: list[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def dbl(expr: str, name: str) -> str:
    return f"CAST({expr} AS DOUBLE) AS {name}"


def rnd(expr: str, name: str) -> str:
    """Rounded like the columns that a query lists under ``rounds``."""
    return f"ROUND(CAST({expr} AS DOUBLE), 6) AS {name}"
