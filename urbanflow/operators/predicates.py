"""Filters, written so that the scan can apply them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import _col
from ..functions.times import month_bounds
from ..schemas import Bound


def in_month(ts: Column | str, year: int, month: int) -> Column:
    """Half-open month range.

    The bounds are text literals, so Spark converts them once to the stored
    type of ``ts`` and the comparison reaches the scan.
    """
    lo, hi = month_bounds(year, month)
    return (_col(ts) >= F.lit(lo)) & (_col(ts) < F.lit(hi))


def bounds_predicate(bounds: Mapping[str, Bound], not_null: Iterable[str] = ()) -> Column:
    """All ranges hold and the named keys are known; NULL in a range fails it."""
    terms = [F.col(c).isNotNull() for c in not_null]
    for name, b in bounds.items():
        c = F.col(name)
        terms.append((c > b.lo if b.lo_open else c >= b.lo) & (c <= b.hi))
    return reduce(lambda p, q: p & q, terms)


def within_bounds(df: DataFrame, bounds: Mapping[str, Bound], not_null: Iterable[str] = ()) -> DataFrame:
    return df.filter(bounds_predicate(bounds, not_null))


def not_blank(df: DataFrame, col: str) -> DataFrame:
    """Rows whose text is neither NULL nor empty."""
    return df.filter(F.col(col).isNotNull() & (F.col(col) != ""))


def exclude_values(df: DataFrame, col: str, values: Iterable[str]) -> DataFrame:
    """Rows whose value is not listed; as SQL's NOT IN, this drops NULL too."""
    return df.filter(~F.col(col).isin(*values))


def drop_nulls(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """Rows without NULL in ``subset``, or in any column."""
    return df.na.drop("any", subset=list(subset) if subset is not None else None)
