"""Daily series: resampling, gap filling, decomposition, lags and splits.

Series operators work on rows already aggregated to one per day and key, so a
window over a key holds as many rows as the calendar has days, however many
trips those days had.  ``keys`` may be empty for a single series.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .rollup import mean_of

AGGREGATES = {"sum": F.sum, "mean": mean_of, "max": F.max, "min": F.min, "count": F.count}


def over(keys: Sequence[str], *order: Column | str) -> WindowSpec:
    """Window over each key; the whole table is one series without keys."""
    w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    return w.orderBy(*order) if order else w


def densify(df: DataFrame, day: str, keys: Sequence[str] = (), zero: Sequence[str] = ()) -> DataFrame:
    """Add the days each series lacks between its first and last one.

    Added rows have NULL values, or 0 in the ``zero`` columns.  Each row emits
    itself and the gap up to its successor, so no calendar has to be joined.
    Rows that repeat a day stay as they are.
    """
    values = [c for c in df.columns if c not in (day, *keys)]
    nxt = F.coalesce(F.lead(day).over(over(keys, day)), F.date_add(day, 1))
    until = F.greatest(F.col(day), F.date_sub(nxt, 1))  # a repeated day has no gap behind it
    spread = df.withColumn("_days", F.sequence(F.col(day), until))
    filled = spread.select(*keys, F.col(day).alias("_stored"), *values, F.explode("_days").alias(day))
    is_real = F.col(day) == F.col("_stored")
    out = []
    for v in values:
        value = F.when(is_real, F.col(v))
        out.append((F.coalesce(value, F.lit(0)) if v in zero else value).alias(v))
    return filled.select(*keys, day, *out)


def resample_daily(
    df: DataFrame,
    ts: str,
    spec: Mapping[str, str],
    keys: Sequence[str] = (),
    day: str = "day",
    fill_gaps: bool = True,
) -> DataFrame:
    """One row per day and key from the first to the last day of each key.

    ``spec`` gives the aggregate of each column.  Days without rows have sum 0
    and count 0, and NULL for the rest; so has a day whose values are all NULL.
    """
    additive = [c for c, how in spec.items() if how in ("sum", "count")]
    aggs = []
    for c, how in spec.items():
        value = AGGREGATES[how](c)
        aggs.append((F.coalesce(value, F.lit(0)) if how == "sum" else value).alias(c))
    daily = df.groupBy(*keys, F.col(ts).cast("date").alias(day)).agg(*aggs)
    daily = daily.filter(F.col(day).isNotNull())
    return densify(daily, day, keys, zero=additive) if fill_gaps else daily


def decompose_additive(
    df: DataFrame, y: str, t: str, keys: Sequence[str] = (), period: int = 7
) -> DataFrame:
    """Classical additive decomposition: observed = trend + seasonal + resid.

    The trend is the centred moving average over one period, NULL where the
    period is not complete.  The seasonal part is the mean detrended value of
    each position in the period, shifted to a zero mean.  Series shorter than
    two periods have no components.
    """
    half, whole = period // 2, over(keys)
    near = over(keys, t).rowsBetween(-half, half)
    width = 2 * half + 1
    y_ = F.col(y).cast("double")
    if period % 2:
        mean = F.avg(y_).over(near)
    else:
        ends = F.first(y_).over(near) + F.last(y_).over(near)
        mean = (F.sum(y_).over(near) - ends / 2) / F.lit(float(period))
    full = (F.count(y_).over(near) == width) & (F.count(F.lit(1)).over(whole) >= 2 * period)

    rows = df.withColumns(
        {"_i": F.row_number().over(over(keys, t)) - 1, "observed": y_, "trend": F.when(full, mean)}
    ).withColumn("_pos", F.col("_i") % period)
    # A window over (key, position) reuses the shuffle by key.
    at_pos = F.avg(F.col("observed") - F.col("trend")).over(over([*keys, "_pos"]))
    rows = rows.withColumn("_raw", at_pos)
    centre = F.avg(F.when(F.col("_i") < period, F.col("_raw"))).over(whole)
    rows = rows.withColumn("seasonal", F.col("_raw") - centre)
    resid = F.col("observed") - F.col("trend") - F.col("seasonal")
    return rows.select(*keys, t, "observed", "trend", "seasonal", resid.alias("resid"))


def with_lags(
    df: DataFrame, y: str, t: str, lags: Sequence[int], keys: Sequence[str] = (), difference: bool = False
) -> DataFrame:
    """Add ``y_lag<k>`` for each k, and the first difference as ``y_diff``."""
    w = over(keys, t)
    cols = {f"{y}_lag{k}": F.lag(y, k).over(w) for k in lags}
    if difference:
        cols[f"{y}_diff"] = F.col(y) - F.lag(y, 1).over(w)
    return df.withColumns(cols)


def time_split(
    df: DataFrame, t: str, frac: float = 0.7, keys: Sequence[str] = (), out: str = "part"
) -> DataFrame:
    """Label the first ``int(frac * n)`` rows of each series train, the rest test."""
    i = F.row_number().over(over(keys, t))
    n = F.count(F.lit(1)).over(over(keys))
    return df.withColumn(out, F.when(i <= F.floor(n * F.lit(frac)), "train").otherwise("test"))


def last_n(df: DataFrame, t: str, n: int, keys: Sequence[str] = ()) -> DataFrame:
    """The latest n rows of each series."""
    if not keys:
        return df.orderBy(F.desc(t)).limit(n)
    rn = F.row_number().over(over(keys, F.desc(t)))
    return df.withColumn("_rn", rn).filter(F.col("_rn") <= n).drop("_rn")
