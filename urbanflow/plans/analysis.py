"""From a published table to daily series and the models fitted to them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import label, unquote
from ..functions.times import parse_time, time_from_parts
from ..operators.correlation import corr_matrix
from ..operators.forecast import backtest, forecast_direct, seasonal_arx, seasonal_summary
from ..operators.predicates import drop_nulls
from ..operators.regression import ols
from ..operators.series import resample_daily
from ..schemas import BOROUGH_VIEW, DAILY_FEATURES, OLS_DRIVERS, SEASONAL_DRIVERS

_NUMBERS = (T.NumericType,)


def clean_published(df: DataFrame, layout: T.StructType = BOROUGH_VIEW, ts: str = "hour_ts") -> DataFrame:
    """Undo stray quotes and text-typed numbers of a published table.

    Text loses quotes and outer spaces, numbers and times that do not parse
    become NULL, the borough gets its canonical label, and rows without a time
    are dropped.  Columns outside the layout pass through.
    """
    want = {f.name.lower(): f.dataType for f in layout}
    out = []
    for field in df.schema:
        name, c = field.name.lower(), F.col(field.name)
        kind = want.get(name)
        text = isinstance(field.dataType, T.StringType)
        if name == ts:
            c = parse_time(unquote(c)) if text else c.cast("timestamp_ntz")
        elif name == "borough":
            c = label(unquote(c))
        elif isinstance(kind, T.StringType) and text:
            c = unquote(c)
        elif isinstance(kind, _NUMBERS) and text:
            c = c.try_cast("double")
        out.append(c.alias(name))
    return df.select(*out).filter(F.col(ts).isNotNull())


def prepare_series(
    df: DataFrame, boroughs: Iterable[str] | None = None, layout: T.StructType = BOROUGH_VIEW
) -> DataFrame:
    """Cleaned rows of the wanted boroughs (all by default) with their time rebuilt from its parts."""
    rows = clean_published(df, layout)
    if boroughs is not None:
        rows = rows.filter(F.col("borough").isin(*boroughs))
    parts = [F.col(c).cast("int").alias(c) for c in ("year", "month", "day", "hour")]
    keep = [c for c in rows.columns if c not in ("year", "month", "day", "hour")]
    return rows.select(*keep, *parts).withColumn("datetime", time_from_parts())


def daily_features(series: DataFrame, keys: Sequence[str] = ("borough",), ts: str = "datetime") -> DataFrame:
    """Daily demand with its drivers, without the days on which any of them is unknown."""
    spec = {c: how for c, how in DAILY_FEATURES.items() if c in series.columns}
    return drop_nulls(resample_daily(series, ts, spec, keys))


def demand_ols(features: DataFrame, drivers: Sequence[str] = OLS_DRIVERS) -> tuple[DataFrame, DataFrame]:
    """Regression of daily trips on weather and complaints with its full summary; see ``ols``."""
    return ols(features, "trips", drivers, order="day", keys=["borough"], diagnostics=True)


# Lags of demand and of shocks: the day before, the same weekday, and their product term.
DEMAND_LAGS = (1, 7, 8)


def demand_model(
    features: DataFrame,
    keys: Sequence[str] = ("borough",),
    drivers: Sequence[str] = SEASONAL_DRIVERS,
    shock_lags: Sequence[int] = DEMAND_LAGS,
) -> tuple[DataFrame, DataFrame]:
    """Seasonal model of daily trips with lagged demand, drivers and shocks; see ``seasonal_arx``."""
    return seasonal_arx(features, "trips", "day", drivers, keys, DEMAND_LAGS, shock_lags)


def demand_summary(
    features: DataFrame,
    keys: Sequence[str] = ("borough",),
    drivers: Sequence[str] = SEASONAL_DRIVERS,
    shock_lags: Sequence[int] = DEMAND_LAGS,
) -> DataFrame:
    """Fit and residual tests of the seasonal model of each series; see ``seasonal_summary``."""
    fits, predicted = demand_model(features, keys, drivers, shock_lags)
    return seasonal_summary(fits, predicted, "trips", "day", keys)


def demand_backtest(
    features: DataFrame,
    keys: Sequence[str] = ("borough",),
    drivers: Sequence[str] = SEASONAL_DRIVERS,
    shock_lags: Sequence[int] = DEMAND_LAGS,
) -> tuple[DataFrame, DataFrame]:
    """Hold-out test of the seasonal model on the last 30 % of days; see ``backtest``."""
    return backtest(features, "trips", "day", drivers, keys, lags=DEMAND_LAGS, shock_lags=shock_lags)


def demand_forecast(
    features: DataFrame,
    keys: Sequence[str] = ("borough",),
    drivers: Sequence[str] = SEASONAL_DRIVERS,
    days: int = 14,
    future: DataFrame | None = None,
) -> DataFrame:
    """Daily trips of the next ``days``; drivers of the last ``days`` are reused without ``future``."""
    return forecast_direct(features, "trips", "day", drivers, keys, days, future_exog=future)


def feature_correlation(features: DataFrame, columns: Iterable[str] = tuple(DAILY_FEATURES)) -> DataFrame:
    """Pairwise correlation of the daily features; see ``corr_matrix``."""
    return corr_matrix(features, [c for c in columns if c in features.columns])
