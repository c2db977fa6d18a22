"""Hourly rollups.

Every aggregate here is a sum or a count, so Spark combines rows inside each
map task first.  A key that holds a third of all rows then sends one partial
row per task, and no reducer sees more rows than there are map tasks per group.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import mentions, mentions_upper
from ..functions.times import bucket
from ..schemas import COMPLAINT_CLASSES, Measure


def mean_of(source: str, unit: float | None = None, digits: int | None = None) -> Column:
    """Mean of a column; NULL where all of its values are.  See ``Measure``."""
    value, n = F.col(source), F.count(source)
    if digits is not None:
        unit = (unit or 1.0) * 10**digits
        value = F.floor(value * F.lit(10.0**digits) + F.lit(0.5))
    return F.try_divide(F.sum(value).cast("double"), n * F.lit(float(unit)) if unit else n)


def hourly_rollup(
    df: DataFrame,
    ts: str,
    keys: Sequence[str],
    measures: Iterable[Measure],
    grain: str = "hour",
    bucket_as: str = "hour_ts",
    count_as: str = "trips",
) -> DataFrame:
    """Row count and means per time bucket and key."""
    means = [mean_of(m.source, m.unit, m.digits).alias(m.mean_as) for m in measures]
    return df.groupBy(bucket(ts, grain).alias(bucket_as), *keys).agg(F.count(F.lit(1)).alias(count_as), *means)


def weighted_rollup(
    df: DataFrame,
    keys: Sequence[str],
    means: Iterable[str],
    weight: str = "trips",
    strict: bool = False,
) -> DataFrame:
    """Combine means of finer groups into means of coarser ones, weighted by row count.

    A NULL mean adds nothing to the total, but its rows stay in the divisor;
    with ``strict`` they leave it.  A group without rows has NULL means.
    """
    total = F.sum(weight)
    out = []
    for m in means:
        rows = F.sum(F.when(F.col(m).isNotNull(), F.col(weight))) if strict else total
        ratio = F.try_divide(F.sum(F.col(m) * F.col(weight)), rows)
        out.append(F.when(total > 0, ratio).alias(m))
    return df.groupBy(*keys).agg(total.alias(weight), *out)


def class_counts(
    text: str,
    classes: Mapping[str, Iterable[str]] = COMPLAINT_CLASSES,
    prefix: str = "complaints",
    by: str = "regex",
) -> list[Column]:
    """One count per keyword class; a text may count in several."""
    test = {"regex": mentions, "upper": mentions_upper}[by]
    return [F.count_if(test(text, words)).alias(f"{prefix}_{name}") for name, words in classes.items()]


def classify_counts(
    df: DataFrame,
    keys: Sequence[Column | str],
    text: str,
    classes: Mapping[str, Iterable[str]] = COMPLAINT_CLASSES,
    total_as: str = "complaints_total",
    prefix: str = "complaints",
    by: str = "regex",
) -> DataFrame:
    """Total and keyword-class counts per key in one pass."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(total_as), *class_counts(text, classes, prefix, by))
