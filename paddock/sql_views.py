"""Named views and dated functions for SQL users, under the names of the feature sets."""

from __future__ import annotations

from pyspark.sql import SparkSession

from paddock.operators.ordered import ROWS_PER_TASK
from paddock.plans import assembly, first_version, horses, people, races
from paddock.plans.starts import asof_starts
from paddock.schema import RacingTables
from paddock.sql_functions import register_functions


def register_views(
    spark: SparkSession, tables: RacingTables, as_of, rows_per_task: int | None = ROWS_PER_TASK
) -> None:
    """Register base tables and feature sets as temporary views.

    The date functions become views fixed at ``as_of``, and table functions that take
    any date (``sql_functions``). Views are planned together
    with the query that reads them, but for the keys with over ``rows_per_task``
    rows: these are counted here, and tables that grow by much should be registered
    again. With None nothing is counted and no job runs.
    """
    starts = asof_starts(tables, as_of)
    dated = {
        "horses_base": horses.horses_base(tables, as_of),
        "horses_career": horses.horses_career(tables, as_of),
        "horses_perf": horses.horses_perf(tables, as_of, starts),
        "horses_recent": horses.horses_recent(tables, as_of, starts),
        "horse_features": horses.horse_features(tables, as_of, starts),
        "jockey_features": people.jockeys(tables, as_of, starts),
        "trainer_features": people.trainers(tables, as_of, starts),
        "breeder_features": people.breeders(tables, as_of, starts),
        "race_features": assembly.race_features(tables, as_of, starts, rows_per_task=rows_per_task),
    }
    fixed = {
        "races_base": races.races_base(tables),
        "races_payouts": races.races_payouts(tables),
        "records_context": races.records_context(tables, rows_per_task),
        "records_outcomes": races.records_outcomes(tables),
        "race_features_v1": first_version.race_features_v1(tables, rows_per_task=rows_per_task),
    }
    base = {name: getattr(tables, name) for name in tables.__dataclass_fields__}
    for name, df in {**base, **dated, **fixed}.items():
        if df is not None:
            df.createOrReplaceTempView(name)
    register_functions(spark, tables)
