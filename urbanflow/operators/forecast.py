"""Seasonal demand models fitted by least squares, for many series at once.

A series is one row per day and key.  The model regresses demand on its own
lags (1, 7 and 8: the previous day, the same weekday, and their product term),
on external drivers, and, if asked, on lagged shocks.
"""

from __future__ import annotations

import math
import sys
from collections import deque
from collections.abc import Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from .correlation import forecast_metrics
from .regression import chi2_p_value, fit_by_key, fit_vectors, linear_score
from .series import over, time_split, with_lags

# The fold travels to the tasks, so the workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LAGS = (1, 7, 8)
_SERIES = "_series"


def _keyed(df: DataFrame, keys: Sequence[str], *cols: str) -> tuple[DataFrame, list[str]]:
    """The series with a key, written once, as fitting and forecasting both read them."""
    rows = df.select(*dict.fromkeys([*keys, *cols])) if cols else df
    if not keys:
        rows, keys = rows.withColumn(_SERIES, F.lit(0)), [_SERIES]
    return stage(rows), list(keys)


def _shocks(rows: DataFrame, y: str, t: str, keys: Sequence[str], order: int, train: Column) -> DataFrame:
    """Add ``_shock``: what an autoregression of ``order`` leaves unexplained, 0 outside training.

    This is the first stage of Hannan and Rissanen (1982); lagged shocks then
    stand in for the moving-average terms.
    """
    w = over(keys, t)
    level = F.avg(F.when(train, F.col(y))).over(over(keys))
    wide = rows.withColumn("_dev", F.col(y) - level)
    wide = wide.withColumn("_past", F.reverse(F.collect_list("_dev").over(w.rowsBetween(-order, -1))))
    usable = wide.filter(train & (F.size("_past") == order) & F.col("_dev").isNotNull())
    usable = usable.withColumn("_vec", F.concat(F.array(F.lit(1.0)), F.col("_past"), F.array(F.col("_dev"))))
    fit = fit_vectors(usable, "_vec", keys).select(*keys, "intercept", "coef")
    explained = F.aggregate(F.zip_with("_past", "coef", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    miss = F.when(train & (F.size("_past") == order), F.col("_dev") - F.col("intercept") - explained)
    out = wide.join(fit, list(keys), "left").withColumn("_shock", F.coalesce(miss, F.lit(0.0)))
    return out.drop("intercept", "coef", "_dev", "_past")


def seasonal_design(
    df: DataFrame,
    y: str,
    t: str,
    keys: Sequence[str],
    lags: Sequence[int] = LAGS,
    shock_lags: Sequence[int] = (),
    train: Column | None = None,
    shock_order: int = 14,
) -> tuple[DataFrame, list[str], list[str]]:
    """Rows with lag columns, and the names of the lag and shock columns."""
    train = train if train is not None else F.lit(True)
    rows = df.withColumn(y, F.col(y).cast("double"))
    shocks = []
    if shock_lags:
        rows = with_lags(_shocks(rows, y, t, keys, shock_order, train), "_shock", t, shock_lags, keys)
        shocks = [f"_shock_lag{k}" for k in shock_lags]
    return with_lags(rows, y, t, lags, keys), [f"{y}_lag{k}" for k in lags], shocks


def seasonal_arx(
    df: DataFrame,
    y: str,
    t: str,
    exog: Sequence[str] = (),
    keys: Sequence[str] = (),
    lags: Sequence[int] = LAGS,
    shock_lags: Sequence[int] = (),
) -> tuple[DataFrame, DataFrame]:
    """Fit the model; returns (fits, rows with ``predicted``).

    ``fits`` has per key n, intercept, coefficients in the order lags, drivers,
    shocks, t values, sse and r2.  ``predicted`` is NULL for the first rows,
    whose lags reach before the series.
    """
    rows, ks = _keyed(df, keys)
    design, lagged, shocks = seasonal_design(rows, y, t, ks, lags, shock_lags)
    xs = [*lagged, *exog, *shocks]
    fits = fit_by_key(design, y, xs, ks, series=True)
    scored = design.join(fits.select(*ks, "intercept", "coef"), ks, "left")
    predicted = F.col("intercept") + linear_score(xs)
    out = scored.select(*[c for c in df.columns if c != y], F.col(y), predicted.alias("predicted"))
    return fits.drop(_SERIES), out


def seasonal_summary(
    fits: DataFrame, predicted: DataFrame, y: str, t: str, keys: Sequence[str] = (), lags: int = 10
) -> DataFrame:
    """Per series how well a model fits and what its residuals still hold; takes the results of ``seasonal_arx``.

    Rows used, terms with the constant, R2, log likelihood, AIC and BIC of
    normal errors, residual autocorrelations of lags 1 to ``lags`` as an array,
    the Ljung-Box test that they are all 0, and skew, kurtosis and the
    Jarque-Bera test of the residuals.  All autocorrelations of all series take
    one aggregate.  A model without error has no statistics of residuals.
    """
    ks = list(keys)
    rows = predicted.select(*ks, F.col(t), (F.col(y) - F.col("predicted")).alias("_raw")).where("_raw is not null")
    if not ks:
        rows, fits, ks = rows.withColumn(_SERIES, F.lit(0)), fits.withColumn(_SERIES, F.lit(0)), [_SERIES]
    w = over(ks, t)
    rows = rows.withColumn("_e", F.col("_raw") - F.avg("_raw").over(over(ks)))
    e = F.col("_e")
    rows = rows.withColumn("_with", F.array(*[e * F.lag(e, k).over(w) for k in range(1, lags + 1)]))
    powers = {f"_m{p}": F.avg(F.pow(e, F.lit(p))) for p in (2, 3, 4)}
    together = F.array(*[F.coalesce(F.sum(F.get("_with", F.lit(k))), F.lit(0.0)) for k in range(lags)])
    sums = rows.groupBy(*ks).agg(F.sum(e * e).alias("_ss"), together.alias("_p"), *[c.alias(n) for n, c in powers.items()])
    n, terms = F.col("n"), F.size("coef") + 1
    loglik = -n / F.lit(2.0) * (F.log(F.lit(2 * math.pi)) + F.log(F.try_divide("sse", n)) + 1)
    joined = fits.select(*ks, n, terms.cast("long").alias("terms"), "r2", loglik.alias("log_likelihood")).join(sums, ks)
    ll = F.col("log_likelihood")
    joined = joined.withColumns({"aic": 2 * F.col("terms") - 2 * ll, "bic": F.col("terms") * F.log(n) - 2 * ll})
    joined = joined.withColumn("autocorrelations", F.transform("_p", lambda p: F.try_divide(p, F.col("_ss"))))
    parts = F.transform("autocorrelations", lambda r, k: r * r / (n - k - 1))
    box = n * (n + 2) * F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)
    skew, kurtosis = F.try_divide("_m3", F.pow("_m2", F.lit(1.5))), F.try_divide("_m4", F.col("_m2") * F.col("_m2"))
    joined = joined.withColumns({"ljung_box": box, "skew": skew, "kurtosis": kurtosis})
    normal = n / F.lit(6.0) * (F.pow("skew", F.lit(2)) + F.pow(F.col("kurtosis") - 3, F.lit(2)) / 4)
    out = joined.withColumns({"ljung_box_p": _chi2_p(lags)("ljung_box"), "jarque_bera": normal})
    return out.select(
        *ks, "n", "terms", "r2", "log_likelihood", "aic", "bic", "autocorrelations", "ljung_box", "ljung_box_p",
        "skew", "kurtosis", "jarque_bera", F.exp(-F.col("jarque_bera") / 2).alias("jarque_bera_p"),
    ).drop(_SERIES)


def _chi2_p(dof: int):
    def run(value: pd.Series) -> pd.Series:
        out = [None if v is None or math.isnan(v) else chi2_p_value(v, dof) for v in value]
        return pd.Series(out, dtype="Float64")

    return F.pandas_udf(run, T.DoubleType())


def forecast_holdout(
    df: DataFrame,
    y: str,
    t: str,
    exog: Sequence[str] = (),
    keys: Sequence[str] = (),
    lags: Sequence[int] = LAGS,
    shock_lags: Sequence[int] = (),
    part: str = "part",
) -> DataFrame:
    """Fit on the rows whose ``part`` is train, forecast the test rows that follow.

    The forecast knows the drivers of the test rows but none of their demand:
    each step feeds on earlier forecasts.  The steps of one series run as a
    fold over one number per test day, whose state is the last ``max(lags)``
    values.
    """
    rows, ks = _keyed(df, keys, t, y, part, *exog)
    is_train = F.col(part) == "train"
    design, lagged, shocks = seasonal_design(rows, y, t, ks, lags, shock_lags, is_train)
    xs = [*lagged, *exog, *shocks]
    fits = fit_by_key(design.filter(is_train), y, xs, ks, series=True).select(*ks, "intercept", "coef")
    # What the drivers and the last known shocks add to each step is known
    # beforehand; only the lag terms depend on earlier steps.
    known = linear_score([*exog, *shocks], first=len(lagged))
    scored = design.join(fits, ks, "left").withColumn("_known", F.col("intercept") + known)

    # The fold starts from the last values of training, as many as the longest lag; no more of the history is gathered.
    depth = max(lags)
    from_end = F.row_number().over(over([*ks, part], F.desc(t)))
    last = F.when(is_train & (F.col("_from_end") <= depth), F.struct(F.col(t).alias("t"), F.col(y).alias("y")))
    future = F.when(~is_train, F.struct(F.col(t).alias("t"), F.col(y).alias("y"), F.col("_known").alias("k")))
    series = scored.withColumn("_from_end", from_end).groupBy(*ks).agg(
        F.array_sort(F.collect_list(last)).alias("_last"),
        F.array_sort(F.collect_list(future)).alias("_steps"),
        F.first("coef", ignorenulls=True).alias("coef"),
    )
    start, known = F.transform("_last", lambda p: p["y"]), F.transform("_steps", lambda s: s["k"])
    ahead = series.filter(F.size("_last") > 0).select(
        *ks, "_steps", _fold(tuple(lags))(start, known, F.coalesce("coef", F.array().cast("array<double>"))).alias("_ahead")
    )
    lined = ahead.select(*ks, F.inline(F.arrays_zip("_steps", "_ahead")))
    out = lined.select(
        *ks, F.col("_steps.t").alias(t), F.col("_steps.y").alias(y), F.col("_ahead").alias("predicted")
    )
    return out.drop(_SERIES)


def _fold(lags: tuple[int, ...]):
    """Forecasts step by step: what is known of a step, and the lag terms of the last ``max(lags)`` values.

    These values are the whole state: each step drops the oldest and appends
    its own forecast.  A step that lacks one of its lags is NULL.
    """

    def run(start: pd.Series, known: pd.Series, coef: pd.Series) -> pd.Series:
        depth, out = max(lags), []
        for first, steps, weights in zip(start, known, coef):
            state = deque([math.nan] * depth, depth)
            state.extend(math.nan if v is None else v for v in first)
            weights = [math.nan if v is None else v for v in weights] or [math.nan] * len(lags)
            path = []
            for k in steps:
                value = math.nan if k is None else k
                for lag, weight in zip(lags, weights):
                    value += weight * state[-lag]
                state.append(value)
                path.append(None if math.isnan(value) else value)
            out.append(path)
        return pd.Series(out, dtype=object)

    return F.pandas_udf(run, T.ArrayType(T.DoubleType()))


def backtest(
    df: DataFrame,
    y: str,
    t: str,
    exog: Sequence[str] = (),
    keys: Sequence[str] = (),
    frac: float = 0.7,
    lags: Sequence[int] = LAGS,
    shock_lags: Sequence[int] = (),
) -> tuple[DataFrame, DataFrame]:
    """Chronological hold-out test; returns (metrics per key, forecasts)."""
    parts = time_split(df, t, frac, keys)
    forecasts = forecast_holdout(parts, y, t, exog, keys, lags, shock_lags)
    return forecast_metrics(forecasts, y, "predicted", keys), forecasts


def seasonal_naive(df: DataFrame, y: str, t: str, keys: Sequence[str] = (), period: int = 7) -> DataFrame:
    """The value one period earlier as prediction, a yardstick for the models."""
    return df.withColumn("predicted", F.lag(F.col(y).cast("double"), period).over(over(keys, t)))


def forecast_direct(
    df: DataFrame,
    y: str,
    t: str,
    exog: Sequence[str] = (),
    keys: Sequence[str] = (),
    horizon: int = 14,
    period: int = 7,
    future_exog: DataFrame | None = None,
) -> DataFrame:
    """Forecast ``horizon`` steps past the end, with one regression per step.

    Step h regresses demand h rows ahead on today's demand, on the latest
    earlier value at the same place in the period, and on the drivers h rows
    ahead.  All steps of all series are fitted in one aggregate.

    Drivers beyond the end come from ``future_exog`` (keys, step, drivers);
    without it the last ``horizon`` observed rows are reused in order.  Where
    today's demand or the one at the same place is unknown, the last known one
    of the period, or of up to three periods before, takes its place; a series
    without those has a NULL forecast.
    """
    rows, ks = _keyed(df, keys, t, y, *exog)
    if future_exog is not None and not keys:
        future_exog = future_exog.withColumn(_SERIES, F.lit(0))
    exog = list(exog)
    w = over(ks, t)
    row = F.struct(F.col(y).cast("double").alias("y"), *[F.col(x).cast("double").alias(x) for x in exog])
    span = rows.select(
        *ks,
        F.col(t),
        F.last(F.col(y).cast("double"), ignorenulls=True).over(w.rowsBetween(1 - period, 0)).alias("_now"),
        F.collect_list(row).over(w.rowsBetween(1, horizon)).alias("_next"),
        F.collect_list(row).over(w.rowsBetween(-(horizon - 1), 0)).alias("_recent"),
        # structs, as a list of values would lose its NULLs and with them the places
        F.collect_list(F.struct(F.col(y).cast("double").alias("y"))).over(w.rowsBetween(-4 * period, -1)).alias("_weeks"),
        F.row_number().over(over(ks, F.desc(t))).alias("_from_end"),
    )
    back = F.lit(period) - F.col("step") % period
    same_place = F.coalesce(*[F.try_element_at("_weeks", (-(back + k * period)).cast("int"))["y"] for k in range(4)])
    full = F.size("_weeks") >= period
    xs = ["_now", "_same", *exog]

    pairs = span.filter(full).select(*ks, "_now", "_weeks", F.posexplode("_next").alias("_pos", "_row"))
    pairs = pairs.withColumn("step", F.col("_pos") + 1).select(
        *ks, "step", "_now", same_place.alias("_same"), F.col("_row.y").alias("_target"),
        *[F.col(f"_row.{x}").alias(x) for x in exog],
    )
    fits = fit_by_key(pairs, "_target", xs, [*ks, "step"], series=True).select(*ks, "step", "intercept", "coef")

    last = span.filter((F.col("_from_end") == 1) & full)
    steps = last.select(
        *ks, F.col(t).alias("origin"), "_now", "_weeks", F.posexplode("_recent").alias("_pos", "_row")
    ).withColumn("step", F.col("_pos") + 1)
    base = steps.select(
        *ks, "origin", "step", "_now", same_place.alias("_same"), *[F.col(f"_row.{x}").alias(x) for x in exog]
    )
    if future_exog is not None:
        base = base.drop(*exog).join(future_exog.select(*ks, "step", *exog), [*ks, "step"])
    scored = base.join(fits, [*ks, "step"], "left")
    forecast = F.col("intercept") + linear_score(xs)
    return scored.select(*ks, "origin", "step", forecast.alias("forecast")).drop(_SERIES)

