"""Correlation matrix and forecast error."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def correlation(x: str, y: str) -> Column:
    """Pearson correlation over rows where both are known; NULL if either is constant."""
    a = F.when(F.col(y).isNotNull(), F.col(x).cast("double"))
    b = F.when(F.col(x).isNotNull(), F.col(y).cast("double"))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def corr_matrix(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Correlation of every pair of columns as rows (var_x, var_y, corr), in one pass.

    Each unordered pair is computed once and listed in both orders.
    """
    pairs = list(combinations_with_replacement(cols, 2))
    wide = df.groupBy(*keys).agg(*[correlation(x, y).alias(f"_c{i}") for i, (x, y) in enumerate(pairs)])
    cells = []
    for i, (x, y) in enumerate(pairs):
        for p, q in {(x, y), (y, x)}:
            cells.append(F.struct(F.lit(p).alias("var_x"), F.lit(q).alias("var_y"), F.col(f"_c{i}").alias("corr")))
    return wide.select(*keys, F.inline(F.array(*cells)))


def forecast_metrics(df: DataFrame, y: str, yhat: str, keys: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and MAPE over rows with both values; zero actuals leave the MAPE."""
    both = df.filter(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    err = F.col(y).cast("double") - F.col(yhat)
    return both.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        (F.avg(F.abs(F.try_divide(err, F.col(y)))) * 100).alias("mape"),
    )
