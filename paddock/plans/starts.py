"""Starts up to a cut-off date: the one fact join under all entity features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.schema import RacingTables

FACTS = ["race_date", "track_type", "track_distance_m"]
STARTER = ["race_id", "horse_id", "jockey_id", "trainer_id", "finish_place"]


def as_date(value) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def up_to(at: Column, as_of) -> Column:
    """``DATE(at) <= as_of`` without a function on the column, so it is pushed
    into the file scan."""
    return at < F.lit(as_date(as_of) + dt.timedelta(days=1))


def after(at: Column, day) -> Column:
    """``DATE(at) > day`` in the same form."""
    return at >= F.lit(as_date(day) + dt.timedelta(days=1))


def one_year_before(as_of) -> dt.date:
    day = as_date(as_of)
    try:
        return day.replace(year=day.year - 1)
    except ValueError:  # 29 February
        return day.replace(year=day.year - 1, day=28)


def asof_starts(tables: RacingTables, as_of) -> DataFrame:
    """Starts whose race ran up to ``as_of``, with the race facts features use.

    Both sides are cut to a few columns before the shuffle on ``race_id``.
    Several features over one date should share the result: pass it as
    ``starts``, materialized with ``paddock.session.materialize`` when the
    tables are large.
    """
    races = tables.races.where(up_to(F.col("race_date"), as_of)).select("race_id", *FACTS)
    return tables.race_records.select(*STARTER).join(races, "race_id")
