"""Rate families: many conditional win rates from one pass over the starts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.functions import scalars as S


def share(hits: Column, of: Column = None) -> Column:
    """Rows that satisfy ``hits`` among those that satisfy ``of`` (NULL if none)."""
    if of is None:
        return S.ratio(F.count_if(hits), F.count(F.lit(1)))
    return S.ratio(F.count_if(hits & of), F.count_if(of))


def rates_by(
    starts: DataFrame,
    keys: list[str],
    totals: dict[str, Column] = None,
    families: dict[str, Column] = None,
    hits: Column = None,
    default: float = None,
) -> DataFrame:
    """One grouped aggregate: ``totals`` as given, and per family a win share.

    Each family is a condition that selects the starts it is measured on. The
    state per key is a fixed set of counters, so partial aggregation absorbs
    hot keys before the shuffle.
    """
    hits = S.is_win() if hits is None else hits
    columns = [expr.alias(name) for name, expr in (totals or {}).items()]
    for name, condition in (families or {}).items():
        rate = share(hits, condition)
        rate = rate if default is None else F.coalesce(rate, F.lit(default))
        columns.append(rate.alias(name))
    return starts.groupBy(*keys).agg(*columns)


def starts_and_wins(starts: DataFrame, key: str, prefix: str, pct: bool = True) -> DataFrame:
    totals = {
        f"{prefix}starts": F.count(F.lit(1)),
        f"{prefix}wins": F.count_if(S.is_win()),
    }
    if pct:
        totals[f"{prefix}win_pct"] = share(S.is_win())
    return rates_by(starts.where(F.col(key).isNotNull()), [key], totals)


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` per key, as an aggregate.

    A row-number window would sort each key in one task; ``max_by`` keeps one
    row per key and task and combines before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*")


def surface_families(prefix: str, surface: Column, labels: dict[str, str]) -> dict[str, Column]:
    return {
        f"{prefix}_{suffix.replace('_', '')}": surface == label for label, suffix in labels.items()
    }


def band_families(prefix: str, metres: Column, bands: dict) -> dict[str, Column]:
    return {f"{prefix}_{name}": S.in_band(metres, *edge) for name, edge in bands.items()}
