"""Daily series: resampling, decomposition, regression and forecasts."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.correlation import corr_matrix, forecast_metrics
from ..operators.forecast import backtest, forecast_direct, seasonal_arx, seasonal_naive, seasonal_summary
from ..operators.predicates import drop_nulls
from ..operators.regression import adf_stat, fit_by_key, ols, simple_ols
from ..operators.series import decompose_additive, last_n, resample_daily, time_split, with_lags
from ..plans.analysis import daily_features, demand_ols, feature_correlation, prepare_series
from ..schemas import DAILY_FEATURES, OLS_DRIVERS
from .inputs import DAILY_SQL, daily_series, table
from .least_squares import least_squares_sql, linear_sql, sse_after
from .registry import query, rounded
from .tables import MASTER_SQL, master_table

BY = ["borough"]


# --- resampling -------------------------------------------------------------


@query(
    "q22_one_borough_daily",
    f"""
WITH {MASTER_SQL}
SELECT CAST(hour_ts AS DATE) AS day, CAST(SUM(trips) AS BIGINT) AS trips,
       CAST(SUM(complaints_311) AS BIGINT) AS complaints_311
FROM master WHERE borough = 'ASIA' GROUP BY 1""",
)
def one_borough_daily(spark: SparkSession, sf: str) -> DataFrame:
    rows = prepare_series(master_table(spark, sf), ["ASIA"])
    return resample_daily(rows, "datetime", {"trips": "sum", "complaints_311": "sum"})


_MEANS_SQL = ",\n".join(
    f"         AVG({c}) AS {c}" for c, how in DAILY_FEATURES.items() if how == "mean"
)
_SUMS_SQL = ",\n".join(
    f"         CAST(SUM({c}) AS BIGINT) AS {c}" for c, how in DAILY_FEATURES.items() if how == "sum" and c != "precip_total"
)
_ROUNDED = [c for c, how in DAILY_FEATURES.items() if how == "mean" or c == "precip_total"]


@query(
    "q22_daily_features",
    f"""
WITH {MASTER_SQL},
daily AS (
  SELECT borough, CAST(hour_ts AS DATE) AS day, MAX(extreme_weather) AS extreme_weather,
         SUM(precip_total) AS precip_total,
{_MEANS_SQL},
{_SUMS_SQL}
  FROM master GROUP BY 1, 2)
SELECT * REPLACE ({", ".join(f"ROUND({c}, 8) AS {c}" for c in _ROUNDED)}) FROM daily
WHERE {" AND ".join(f"{c} IS NOT NULL" for c in DAILY_FEATURES)}""",
)
def features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(daily_features(prepare_series(master_table(spark, sf))), 8, *_ROUNDED)


@query("q23_densified_series", f"WITH {DAILY_SQL} SELECT borough, day, trips FROM daily")
def densified_series(spark: SparkSession, sf: str) -> DataFrame:
    return daily_series(spark, sf).select("borough", "day", "trips")


@query("q24_mixed_resample", f"WITH {DAILY_SQL} SELECT * FROM daily WHERE mean_price IS NOT NULL")
def mixed_resample(spark: SparkSession, sf: str) -> DataFrame:
    return drop_nulls(daily_series(spark, sf))


# --- structure --------------------------------------------------------------

CORR_COLS = ("trips", "mean_price", "max_price", "revenue")
_CORR_SQL = "\nUNION ALL\n".join(
    f"SELECT borough, '{a}' AS var_x, '{b}' AS var_y, ROUND(corr({a}, {b}), 8) AS corr "
    "FROM daily WHERE mean_price IS NOT NULL GROUP BY 1"
    for a in CORR_COLS
    for b in CORR_COLS
)


_FEATURES_SQL = f"""{MASTER_SQL},
daily AS (
  SELECT borough, CAST(hour_ts AS DATE) AS day, MAX(extreme_weather) AS extreme_weather,
         SUM(precip_total) AS precip_total,
{_MEANS_SQL},
{_SUMS_SQL}
  FROM master GROUP BY 1, 2),
known AS (SELECT * FROM daily WHERE {" AND ".join(f"{c} IS NOT NULL" for c in DAILY_FEATURES)})"""
_FEATURE_CORR_SQL = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS var_x, '{b}' AS var_y, ROUND(corr({a}, {b}), 6) AS corr FROM known"
    for a in DAILY_FEATURES
    for b in DAILY_FEATURES
)


@query("q25_feature_correlation", f"WITH {_FEATURES_SQL}\n{_FEATURE_CORR_SQL}")
def feature_correlations(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(feature_correlation(daily_features(prepare_series(master_table(spark, sf)))), 6, "corr")


@query("q25_correlation", f"WITH {DAILY_SQL}\n{_CORR_SQL}")
def correlations(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(corr_matrix(mixed_resample(spark, sf), CORR_COLS, BY), 8, "corr")


def _decompose_sql(source: str, key: str, t: str) -> str:
    return f"""
numbered AS (
  SELECT {key}, {t}, CAST(y AS DOUBLE) AS observed,
         ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {t}) - 1 AS i,
         CASE WHEN COUNT(*) OVER near = 7 THEN AVG(CAST(y AS DOUBLE)) OVER near END AS trend
  FROM {source} WINDOW near AS (PARTITION BY {key} ORDER BY {t} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
positions AS (SELECT {key}, i % 7 AS pos, AVG(observed - trend) AS raw FROM numbered GROUP BY 1, 2),
centred AS (SELECT {key}, pos, raw - AVG(raw) OVER (PARTITION BY {key}) AS seasonal FROM positions)
SELECT n.{key}, n.{t}, observed, ROUND(trend, 6) AS trend, ROUND(seasonal, 6) AS seasonal,
       ROUND(observed - trend - seasonal, 6) AS resid
FROM numbered n JOIN centred c ON n.{key} = c.{key} AND n.i % 7 = c.pos"""


@query(
    "q26_decomposition",
    "WITH counts AS (SELECT event_type, CAST(ts AS DATE) AS day, COUNT(*) AS y FROM events GROUP BY 1, 2),"
    + _decompose_sql("counts", "event_type", "day"),
)
def decomposition(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select("event_type", "ts", F.lit(1).alias("y"))
    daily = resample_daily(rows, "ts", {"y": "sum"}, ["event_type"])
    return rounded(decompose_additive(daily, "y", "day", ["event_type"]), 6, "trend", "seasonal", "resid")


@query("q26_region_decomposition", f"WITH {DAILY_SQL}," + _decompose_sql("seq", "borough", "day"))
def region_decomposition(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(decompose_additive(daily_series(spark, sf), "trips", "day", BY), 6, "trend", "seasonal", "resid")


@query(
    "q27_lags",
    f"""
WITH {DAILY_SQL}
SELECT borough, day, trips, LAG(trips, 1) OVER w AS trips_lag1, LAG(trips, 7) OVER w AS trips_lag7,
       trips - LAG(trips, 1) OVER w AS trips_diff
FROM daily WINDOW w AS (PARTITION BY borough ORDER BY day)""",
)
def lags(spark: SparkSession, sf: str) -> DataFrame:
    series = daily_series(spark, sf).select("borough", "day", "trips")
    return with_lags(series, "trips", "day", [1, 7], BY, difference=True)


# Lags tried by default: 27 for the days that orders span; the SQL has room for some more.
_LAGS = [f"e{k}" for k in range(1, 31)]
_UNIT_ROOT_SQL = f"""{DAILY_SQL},
steps AS (
  SELECT borough, i, n, LAG(y) OVER w - AVG(y) OVER (PARTITION BY borough) AS lev, y - LAG(y) OVER w AS d,
         GREATEST(LEAST(CAST(ceil(12 * power(n / CAST(100 AS DOUBLE), 0.25)) AS BIGINT), n // 2 - 2, 30), 0) AS most
  FROM seq WINDOW w AS (PARTITION BY borough ORDER BY day)),
wide AS (
  SELECT *, {", ".join(f"LAG(d, {k}) OVER w AS b{k}" for k in range(1, 31))}
  FROM steps WINDOW w AS (PARTITION BY borough ORDER BY i)),
tried_rows_in AS (
  SELECT borough, lev, d, most + 1 AS live, {", ".join(f"CASE WHEN most >= {k} THEN b{k} ELSE 0 END AS e{k}" for k in range(1, 31))}
  FROM wide WHERE i >= most + 2),
{least_squares_sql("tried_rows_in", "d", ("lev", *_LAGS), ("borough",), "tried", "live")},
sizes AS ({" UNION ALL ".join(f"SELECT borough, n, {p - 1} AS lags, {sse_after(p, 31)} AS sse FROM tried_{p}" for p in range(1, 32))}),
chosen AS (
  SELECT borough, arg_min(lags, [n * ln(sse / n) + 2 * (lags + 2), lags]) AS used
  FROM sizes JOIN (SELECT DISTINCT borough, most FROM steps) USING (borough) WHERE lags <= most GROUP BY 1),
final_rows_in AS (
  SELECT borough, lev, d, used + 1 AS live, {", ".join(f"CASE WHEN used >= {k} THEN b{k} ELSE 0 END AS e{k}" for k in range(1, 31))}
  FROM wide JOIN chosen USING (borough) WHERE i >= used + 2),
{least_squares_sql("final_rows_in", "d", ("lev", *_LAGS), ("borough",), "final", "live")},
stats AS (
  SELECT borough, n, used, coef[1] / sqrt(sse / (n - used - 2) * inverse[1]) AS stat FROM final JOIN chosen USING (borough))"""


@query(
    "q27_unit_root",
    f"""
WITH {_UNIT_ROOT_SQL}
SELECT borough, CAST(n AS BIGINT) AS n_obs, CAST(used AS INTEGER) AS used_lag, ROUND(stat, 6) AS adf_stat,
       ROUND(CAST(-3.43035 AS DOUBLE) - 6.5393 / n - 16.786 / (n * n) - 79.433 / (n * n * n), 8) AS crit_1,
       ROUND(CAST(-2.86154 AS DOUBLE) - 2.8903 / n - 4.234 / (n * n) - 40.04 / (n * n * n), 8) AS crit_5,
       ROUND(CAST(-2.56677 AS DOUBLE) - 1.5384 / n - 2.809 / (n * n), 8) AS crit_10
FROM stats""",
)
def unit_root(spark: SparkSession, sf: str) -> DataFrame:
    result = adf_stat(daily_series(spark, sf), "trips", "day", BY).drop("p_value")
    return rounded(rounded(result, 6, "adf_stat"), 8, "crit_1", "crit_5", "crit_10")


@query(
    "q27_unit_root_no_lags",
    f"""
WITH {DAILY_SQL},
steps AS (SELECT borough, LAG(y) OVER w AS x, y - LAG(y) OVER w AS d FROM seq WINDOW w AS (PARTITION BY borough ORDER BY day)),
fit AS (
  SELECT borough, COUNT(x) AS n, regr_slope(d, x) AS b, regr_sxx(d, x) AS sxx,
         regr_syy(d, x) - regr_slope(d, x) * regr_sxy(d, x) AS sse FROM steps GROUP BY 1)
SELECT borough, CAST(n AS BIGINT) AS n_obs, CAST(0 AS INTEGER) AS used_lag, ROUND(b / sqrt(sse / (n - 2) / sxx), 6) AS adf_stat,
       ROUND(CAST(-2.86154 AS DOUBLE) - 2.8903 / n - 4.234 / (n * n) - 40.04 / (n * n * n), 8) AS crit_5
FROM fit""",
)
def unit_root_no_lags(spark: SparkSession, sf: str) -> DataFrame:
    result = adf_stat(daily_series(spark, sf), "trips", "day", BY, max_lag=0)
    return rounded(rounded(result, 6, "adf_stat"), 8, "crit_5").select("borough", "n_obs", "used_lag", "adf_stat", "crit_5")


# --- regression -------------------------------------------------------------


@query(
    "q28_single_driver",
    f"""
WITH {DAILY_SQL}
SELECT borough, CAST(regr_count(revenue, trips) AS BIGINT) AS n, ROUND(regr_slope(revenue, trips), 6) AS slope,
       ROUND(regr_intercept(revenue, trips), 6) AS intercept, ROUND(regr_r2(revenue, trips), 8) AS r2
FROM daily GROUP BY 1""",
)
def single_driver(spark: SparkSession, sf: str) -> DataFrame:
    fit = simple_ols(daily_series(spark, sf), "revenue", "trips", BY)
    return rounded(rounded(fit, 6, "slope", "intercept"), 8, "r2")


def two_driver_sql(source: str, y: str, a: str, b: str, keys: str) -> str:
    """Least squares on two drivers by Cramer's rule."""
    return f"""
moments AS (
  SELECT {keys}, COUNT(*) AS n, AVG({y}) AS my, AVG({a}) AS ma, AVG({b}) AS mb, var_pop({y}) AS syy,
         var_pop({a}) AS saa, var_pop({b}) AS sbb, covar_pop({a}, {b}) AS sab,
         covar_pop({a}, {y}) AS say, covar_pop({b}, {y}) AS sby
  FROM {source} WHERE {y} IS NOT NULL AND {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY {keys}),
slopes AS (
  SELECT *, (say * sbb - sby * sab) / (saa * sbb - sab * sab) AS ca,
         (sby * saa - say * sab) / (saa * sbb - sab * sab) AS cb FROM moments),
fit AS (
  SELECT *, my - ca * ma - cb * mb AS c0, n * (syy - ca * say - cb * sby) AS sse,
         saa * sbb - sab * sab AS det FROM slopes)"""


@query(
    "q28_two_drivers_by_region",
    f"""
WITH {DAILY_SQL},{two_driver_sql('daily', 'trips', 'mean_price', 'max_price', 'borough')}
SELECT borough, n, ROUND(c0, 6) AS intercept, ROUND(ca, 8) AS coef_mean_price, ROUND(cb, 8) AS coef_max_price,
       ROUND(1 - sse / (n * syy), 8) AS r2 FROM fit""",
)
def two_drivers_by_region(spark: SparkSession, sf: str) -> DataFrame:
    fit = fit_by_key(daily_series(spark, sf), "trips", ["mean_price", "max_price"], BY)
    named = fit.select(
        "borough", "n", "intercept", F.get("coef", F.lit(0)).alias("coef_mean_price"),
        F.get("coef", F.lit(1)).alias("coef_max_price"), "r2",
    )
    return rounded(rounded(named, 6, "intercept"), 8, "coef_mean_price", "coef_max_price", "r2")


@query(
    "q28_ols",
    f"""
WITH {DAILY_SQL},{two_driver_sql('(SELECT *, 1 AS one FROM daily)', 'trips', 'mean_price', 'max_price', 'one')},
terms AS (
  SELECT 'mean_price' AS term, ca AS coef, sqrt(sse / (n - 3) * sbb / (n * det)) AS std_err FROM fit
  UNION ALL SELECT 'max_price', cb, sqrt(sse / (n - 3) * saa / (n * det)) FROM fit
  UNION ALL SELECT 'const', c0, sqrt(sse / (n - 3) / n * (1 + (ma * ma * sbb + mb * mb * saa - 2 * ma * mb * sab) / det)) FROM fit)
SELECT term, ROUND(coef, 6) AS coef, ROUND(std_err, 6) AS std_err, ROUND(coef / std_err, 4) AS t FROM terms""",
)
def ols_coefficients(spark: SparkSession, sf: str) -> DataFrame:
    coefficients, _ = ols(daily_series(spark, sf), "trips", ["mean_price", "max_price"])
    return rounded(rounded(coefficients.select("term", "coef", "std_err", "t"), 6, "coef", "std_err"), 4, "t")


# On larger tables every day has extreme weather; a driver that never varies has no coefficient to compare.
_VARYING = tuple(x for x in OLS_DRIVERS if x != "extreme_weather")


@query(
    "q28_demand_fit",
    f"""
WITH {_FEATURES_SQL},
pooled AS (SELECT 1 AS one, * FROM known),
{least_squares_sql("pooled", "trips", _VARYING, ("one",), "fit")},
terms AS (
  SELECT unnest([{", ".join(f"'{x}'" for x in _VARYING)}]) AS term, unnest(coef) AS coef,
         unnest(list_transform(inverse, lambda v: sqrt(sse / (n - {len(_VARYING)} - 1) * v))) AS std_err FROM fit)
SELECT term, ROUND(coef, 6) AS coef, ROUND(std_err, 6) AS std_err, ROUND(coef / std_err, 4) AS t FROM terms""",
)
def demand_fit(spark: SparkSession, sf: str) -> DataFrame:
    coefficients, _ = demand_ols(daily_features(prepare_series(master_table(spark, sf))), _VARYING)
    drivers = coefficients.where("term <> 'const'").select("term", "coef", "std_err", "t")
    return rounded(rounded(drivers, 6, "coef", "std_err"), 4, "t")


# Extreme weather of just one code, so that it varies from day to day in tables of any size.
_VARIED_SQL = _FEATURES_SQL.replace("MAX(extreme_weather)", "CAST(MAX(CASE WHEN snow_code = 18 THEN 1 ELSE 0 END) AS INTEGER)")
_DEMAND_SQL = f"""{_VARIED_SQL},
pooled AS (SELECT 1 AS one, * FROM known),
{least_squares_sql("pooled", "trips", OLS_DRIVERS, ("one",), "fit")},
errors AS (
  SELECT fit.*, n - 8 AS dof, sse / (n - 8) AS s2,
         list_inner_product(fit.mx, list_transform(m, lambda r: list_inner_product(r[9:15], fit.mx))) AS around
  FROM fit JOIN (SELECT one, m FROM fit_7) USING (one))"""


def varied_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = prepare_series(master_table(spark, sf))
    return daily_features(rows.withColumn("extreme_weather", F.when(F.col("snow_code") == 18, 1).otherwise(0)))


@query(
    "q28_demand_ols",
    f"""
WITH {_DEMAND_SQL},
terms AS (
  SELECT unnest([{", ".join(f"'{x}'" for x in OLS_DRIVERS)}]) AS term, unnest(coef) AS coef,
         unnest(list_transform(inverse, lambda v: sqrt(s2 * v))) AS std_err FROM errors
  UNION ALL SELECT 'const', my - list_inner_product(coef, mx), sqrt(s2 * (CAST(1 AS DOUBLE) / n + around)) FROM errors)
SELECT term, ROUND(coef, 5) AS coef, ROUND(std_err, 5) AS std_err, ROUND(coef / std_err, 4) AS t FROM terms""",
)
def demand_regression(spark: SparkSession, sf: str) -> DataFrame:
    """The seven-driver regression on the daily features of all boroughs."""
    terms = demand_ols(varied_features(spark, sf))[0].select("term", "coef", "std_err", "t")
    return rounded(rounded(terms, 5, "coef", "std_err"), 4, "t")


@query(
    "q28_demand_summary",
    f"""
WITH {_DEMAND_SQL},
residuals AS (
  SELECT borough, day, trips - ({linear_sql("fit", OLS_DRIVERS)}) AS e FROM known, fit),
moments AS (
  SELECT AVG(e * e) AS m2, AVG(e * e * e) AS m3, AVG(e * e * e * e) AS m4, SUM(e * e) AS ss, SUM(step * step) AS steps
  FROM (SELECT *, e - LAG(e) OVER (PARTITION BY borough ORDER BY day) AS step FROM residuals)),
tests AS (SELECT *, m3 / power(m2, 1.5) AS skew, m4 / (m2 * m2) AS kurtosis, steps / ss AS dw FROM moments),
summary AS (
  SELECT n, dof, 1 - sse / syy AS r2, -n / CAST(2 AS DOUBLE) * (ln(2 * pi()) + ln(sse / n) + 1) AS ll, skew, kurtosis, dw,
         n / CAST(6 AS DOUBLE) * (skew * skew + (kurtosis - 3) * (kurtosis - 3) / 4) AS jb
  FROM errors, tests)
SELECT CAST(n AS BIGINT) AS n, CAST(dof AS BIGINT) AS df_resid, ROUND(r2, 8) AS r2, ROUND(1 - (1 - r2) * (n - 1) / dof, 8) AS adj_r2,
       ROUND((r2 / 7) / ((1 - r2) / dof), 4) AS f_stat, ROUND(ll, 4) AS log_likelihood, ROUND(16 - 2 * ll, 4) AS aic,
       ROUND(8 * ln(n) - 2 * ll, 4) AS bic, ROUND(skew, 6) AS skew, ROUND(kurtosis, 6) AS kurtosis, ROUND(jb, 4) AS jarque_bera,
       ROUND(exp(-jb / 2), 6) AS jarque_bera_p, ROUND(dw, 6) AS durbin_watson
FROM summary""",
)
def demand_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Fit and residual tests of that regression."""
    row = demand_ols(varied_features(spark, sf))[1].drop("f_p_value", "cond_no")
    row = rounded(row, 8, "r2", "adj_r2")
    row = rounded(row, 4, "f_stat", "log_likelihood", "aic", "bic", "jarque_bera")
    return rounded(row, 6, "skew", "kurtosis", "jarque_bera_p", "durbin_watson")


# --- forecasts --------------------------------------------------------------


@query(
    "q30_last_14_days",
    f"WITH {DAILY_SQL} SELECT borough, day, trips FROM seq WHERE i > n - 14",
)
def last_14_days(spark: SparkSession, sf: str) -> DataFrame:
    return last_n(daily_series(spark, sf).select("borough", "day", "trips"), "day", 14, BY)


@query(
    "q30_direct_forecast",
    f"""
WITH {DAILY_SQL},
spans AS (
  SELECT borough, day, i, n, y AS now,
         list(y) OVER (PARTITION BY borough ORDER BY day ROWS BETWEEN 1 FOLLOWING AND 14 FOLLOWING) AS nxt,
         list(y) OVER (PARTITION BY borough ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS week
  FROM seq),
steps AS (SELECT *, unnest(range(1, 15)) AS step FROM spans WHERE i > 7),
pairs AS (SELECT borough, step, now, week[step % 7 + 1] AS same, nxt[step] AS target FROM steps),{two_driver_sql('pairs', 'target', 'now', 'same', 'borough, step')}
SELECT f.borough, s.day AS origin, CAST(f.step AS INTEGER) AS step,
       ROUND(c0 + ca * now + cb * week[s.step % 7 + 1], 6) AS forecast
FROM fit f JOIN steps s ON s.borough = f.borough AND s.step = f.step WHERE s.i = s.n""",
)
def direct_forecast(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(forecast_direct(daily_series(spark, sf), "trips", "day", keys=BY), 6, "forecast")


_DRIVEN_SQL = f"""{DAILY_SQL},
filled AS (SELECT borough, day, i, n, y, COALESCE(mean_price, 0) AS p1, COALESCE(max_price, 0) AS p2 FROM seq)"""
_STEP_DRIVERS = ("now", "same", "p1", "p2")


@query(
    "q30_direct_forecast_with_drivers",
    f"""
WITH {_DRIVEN_SQL},
spans AS (
  SELECT borough, day, i, n, y AS now, list(y) OVER nxt AS ys, list(p1) OVER nxt AS p1s, list(p2) OVER nxt AS p2s,
         list(y) OVER (PARTITION BY borough ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS week,
         list(p1) OVER rec AS r1s, list(p2) OVER rec AS r2s
  FROM filled WINDOW nxt AS (PARTITION BY borough ORDER BY day ROWS BETWEEN 1 FOLLOWING AND 14 FOLLOWING),
    rec AS (PARTITION BY borough ORDER BY day ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)),
steps AS (SELECT *, unnest(range(1, 15)) AS step FROM spans WHERE i > 7),
pairs AS (
  SELECT borough, step, now, week[step % 7 + 1] AS same, ys[step] AS target, p1s[step] AS p1, p2s[step] AS p2 FROM steps),
{least_squares_sql("pairs", "target", _STEP_DRIVERS, ("borough", "step"), "fit")},
last AS (SELECT borough, day, step, now, week[step % 7 + 1] AS same, r1s[step] AS p1, r2s[step] AS p2 FROM steps WHERE i = n)
SELECT l.borough, day AS origin, CAST(l.step AS INTEGER) AS step, ROUND({linear_sql("fit", _STEP_DRIVERS)}, 6) AS forecast
FROM last l JOIN fit ON l.borough = fit.borough AND l.step = fit.step""",
)
def direct_forecast_with_drivers(spark: SparkSession, sf: str) -> DataFrame:
    series = daily_series(spark, sf).na.fill(0.0)
    return rounded(forecast_direct(series, "trips", "day", ["mean_price", "max_price"], BY), 6, "forecast")


@query(
    "q31_time_split",
    f"""
WITH {DAILY_SQL}
SELECT borough, day, trips, CASE WHEN i <= floor(n * CAST(0.7 AS DOUBLE)) THEN 'train' ELSE 'test' END AS part FROM seq""",
)
def split_series(spark: SparkSession, sf: str) -> DataFrame:
    return time_split(daily_series(spark, sf).select("borough", "day", "trips"), "day", 0.7, BY)


LAGGED_SQL = f"""{DAILY_SQL},
lagged AS (
  SELECT borough, day, y, i, n, LAG(y, 1) OVER w AS l1, LAG(y, 7) OVER w AS l7
  FROM seq WINDOW w AS (PARTITION BY borough ORDER BY day))"""


@query(
    "q32_seasonal_model",
    f"""
WITH {LAGGED_SQL},{two_driver_sql('lagged', 'y', 'l1', 'l7', 'borough')}
SELECT l.borough, day, y AS trips, ROUND(c0 + ca * l1 + cb * l7, 6) AS predicted
FROM lagged l JOIN fit f ON l.borough = f.borough""",
)
def seasonal_model(spark: SparkSession, sf: str) -> DataFrame:
    series = daily_series(spark, sf).select("borough", "day", "trips")
    _, predicted = seasonal_arx(series, "trips", "day", keys=BY, lags=(1, 7))
    return rounded(predicted, 6, "predicted")


_CHI2_TAIL = " + ".join(f"power(q / 2, {i}) / {math.factorial(i)}" for i in range(5))


@query(
    "q32_model_summary",
    f"""
WITH {LAGGED_SQL},{two_driver_sql('lagged', 'y', 'l1', 'l7', 'borough')},
resid AS (
  SELECT l.borough, day, y - (c0 + ca * l1 + cb * l7) AS raw FROM lagged l JOIN fit f ON l.borough = f.borough WHERE l7 IS NOT NULL),
centred AS (SELECT borough, day, raw - AVG(raw) OVER (PARTITION BY borough) AS e FROM resid),
products AS (
  SELECT *, {", ".join(f"e * LAG(e, {k}) OVER w AS p{k}" for k in range(1, 11))}
  FROM centred WINDOW w AS (PARTITION BY borough ORDER BY day)),
residual_moments AS (
  SELECT borough, AVG(e * e) AS m2, AVG(e * e * e) AS m3, AVG(e * e * e * e) AS m4,
         [{", ".join(f"SUM(p{k}) / SUM(e * e)" for k in range(1, 11))}] AS r
  FROM products GROUP BY 1),
tests AS (
  SELECT fit.*, r, m3 / power(m2, 1.5) AS skew, m4 / (m2 * m2) AS kurtosis,
         n * (n + 2) * list_sum(list_transform(r, lambda v, k: v * v / (n - k))) AS q,
         -n / CAST(2 AS DOUBLE) * (ln(2 * pi()) + ln(sse / n) + 1) AS ll
  FROM fit JOIN residual_moments USING (borough))
SELECT borough, n, CAST(3 AS BIGINT) AS terms, ROUND(1 - sse / (n * syy), 8) AS r2, ROUND(ll, 4) AS log_likelihood,
       ROUND(6 - 2 * ll, 4) AS aic, ROUND(3 * ln(n) - 2 * ll, 4) AS bic, ROUND(r[1], 6) AS r1, ROUND(r[10], 6) AS r10,
       ROUND(q, 4) AS ljung_box, ROUND(exp(-q / 2) * ({_CHI2_TAIL}), 6) AS ljung_box_p, ROUND(skew, 6) AS skew,
       ROUND(kurtosis, 6) AS kurtosis,
       ROUND(n / CAST(6 AS DOUBLE) * (skew * skew + (kurtosis - 3) * (kurtosis - 3) / 4), 4) AS jarque_bera
FROM tests""",
)
def model_summary(spark: SparkSession, sf: str) -> DataFrame:
    series = daily_series(spark, sf).select("borough", "day", "trips")
    fits, predicted = seasonal_arx(series, "trips", "day", keys=BY, lags=(1, 7))
    out = seasonal_summary(fits, predicted, "trips", "day", BY)
    ends = [F.element_at("autocorrelations", k).alias(f"r{k}") for k in (1, 10)]
    out = out.select("*", *ends).drop("autocorrelations", "jarque_bera_p")
    out = rounded(rounded(out, 8, "r2"), 4, "log_likelihood", "aic", "bic", "ljung_box", "jarque_bera")
    return rounded(out, 6, "r1", "r10", "ljung_box_p", "skew", "kurtosis")


_PAST = [f"d{k}" for k in range(1, 15)]
_FULL = ("l1", "l7", "l8", "p1", "p2", "s1", "s7", "s8")


@query(
    "q32_seasonal_model_full",
    f"""
WITH {_DRIVEN_SQL},
levels AS (SELECT *, y - AVG(y) OVER (PARTITION BY borough) AS dev FROM filled),
past AS (
  SELECT *, {", ".join(f"LAG(dev, {k}) OVER w AS d{k}" for k in range(1, 15))}
  FROM levels WINDOW w AS (PARTITION BY borough ORDER BY day)),
{least_squares_sql("past", "dev", _PAST, ("borough",), "ar")},
shocked AS (
  SELECT past.*, COALESCE(dev - ({linear_sql("ar", _PAST)}), 0) AS shock FROM past JOIN ar ON past.borough = ar.borough),
lagged AS (
  SELECT borough, day, y, p1, p2, {", ".join(f"LAG(y, {k}) OVER w AS l{k}, LAG(shock, {k}) OVER w AS s{k}" for k in (1, 7, 8))}
  FROM shocked WINDOW w AS (PARTITION BY borough ORDER BY day)),
{least_squares_sql("lagged", "y", _FULL, ("borough",), "fit")}
SELECT l.borough, day, y AS trips, ROUND({linear_sql("fit", _FULL)}, 5) AS predicted
FROM lagged l JOIN fit ON l.borough = fit.borough""",
)
def seasonal_model_full(spark: SparkSession, sf: str) -> DataFrame:
    """All terms: lags 1, 7 and 8, lagged shocks, and two drivers."""
    series = daily_series(spark, sf).na.fill(0.0)
    _, predicted = seasonal_arx(
        series, "trips", "day", ["mean_price", "max_price"], BY, shock_lags=(1, 7, 8)
    )
    return rounded(predicted.select("borough", "day", "trips", "predicted"), 5, "predicted")


_METRICS_SQL = """COUNT(*) AS n, ROUND(AVG(abs(y - p)), 6) AS mae, ROUND(sqrt(AVG((y - p) * (y - p))), 6) AS rmse,
       ROUND(AVG(abs((y - p) / NULLIF(y, 0))) * 100, 6) AS mape"""


@query(
    "q33_naive_metrics",
    f"""
WITH {DAILY_SQL},
scored AS (SELECT borough, y, LAG(y, 7) OVER (PARTITION BY borough ORDER BY day) AS p FROM seq)
SELECT borough, {_METRICS_SQL} FROM scored WHERE p IS NOT NULL GROUP BY 1""",
)
def naive_metrics(spark: SparkSession, sf: str) -> DataFrame:
    scored = seasonal_naive(daily_series(spark, sf), "trips", "day", BY)
    return rounded(forecast_metrics(scored, "trips", "predicted", BY), 6, "mae", "rmse", "mape")


@query(
    "q33_backtest",
    f"""
WITH RECURSIVE {LAGGED_SQL},
train AS (SELECT * FROM lagged WHERE i <= floor(n * CAST(0.7 AS DOUBLE))),{two_driver_sql('train', 'y', 'l1', 'l7', 'borough')},
ends AS (SELECT borough, MAX(i) AS i, ANY_VALUE(n) AS n, list(y ORDER BY i) AS ys FROM train GROUP BY 1),
path AS (
  SELECT borough, i, n, ys[len(ys) - 6 : len(ys)] AS h FROM ends
  UNION ALL
  SELECT p.borough, p.i + 1, p.n, list_append(p.h[2:7], c0 + ca * p.h[7] + cb * p.h[1])
  FROM path p JOIN fit f ON p.borough = f.borough WHERE p.i < p.n),
scored AS (
  SELECT s.borough, s.y, p.h[7] AS p FROM path p JOIN seq s ON s.borough = p.borough AND s.i = p.i
  WHERE p.i > floor(s.n * CAST(0.7 AS DOUBLE)))
SELECT borough, {_METRICS_SQL} FROM scored GROUP BY 1""",
)
def backtest_metrics(spark: SparkSession, sf: str) -> DataFrame:
    series = daily_series(spark, sf).select("borough", "day", "trips")
    metrics, _ = backtest(series, "trips", "day", keys=BY, lags=(1, 7))
    return rounded(metrics, 6, "mae", "rmse", "mape")


@query(
    "q33_backtest_with_drivers",
    f"""
WITH RECURSIVE {_DRIVEN_SQL},
cut AS (SELECT *, i <= floor(n * CAST(0.7 AS DOUBLE)) AS train FROM filled),
levels AS (SELECT *, y - AVG(y) FILTER (train) OVER (PARTITION BY borough) AS dev FROM cut),
past AS (
  SELECT *, {", ".join(f"LAG(dev, {k}) OVER w AS d{k}" for k in range(1, 15))}
  FROM levels WINDOW w AS (PARTITION BY borough ORDER BY day)),
trained AS (SELECT * FROM past WHERE train),
{least_squares_sql("trained", "dev", _PAST, ("borough",), "ar")},
shocked AS (
  SELECT past.*, CASE WHEN train THEN COALESCE(dev - ({linear_sql("ar", _PAST)}), 0) ELSE 0 END AS shock
  FROM past JOIN ar ON past.borough = ar.borough),
lagged AS (
  SELECT borough, i, n, y, train, p1, p2, {", ".join(f"LAG(y, {k}) OVER w AS l{k}, LAG(shock, {k}) OVER w AS s{k}" for k in (1, 7, 8))}
  FROM shocked WINDOW w AS (PARTITION BY borough ORDER BY day)),
fitted AS (SELECT * FROM lagged WHERE train),
{least_squares_sql("fitted", "y", _FULL, ("borough",), "fit")},
known AS (
  SELECT l.borough, i, y, coef, my - list_inner_product(coef, mx) + coef[4] * p1 + coef[5] * p2 + coef[6] * s1 + coef[7] * s7 + coef[8] * s8 AS k
  FROM lagged l JOIN fit ON l.borough = fit.borough),
ends AS (SELECT borough, MAX(i) AS i, ANY_VALUE(n) AS n, list(y ORDER BY i) AS ys FROM cut WHERE train GROUP BY 1),
path AS (
  SELECT borough, i, n, ys[len(ys) - 7 : len(ys)] AS h FROM ends
  UNION ALL
  SELECT p.borough, p.i + 1, p.n, list_append(p.h[2:8], k + coef[1] * p.h[8] + coef[2] * p.h[2] + coef[3] * p.h[1])
  FROM path p JOIN known s ON s.borough = p.borough AND s.i = p.i + 1 WHERE p.i < p.n),
scored AS (
  SELECT s.borough, s.y, p.h[8] AS p FROM path p JOIN cut s ON s.borough = p.borough AND s.i = p.i WHERE NOT s.train)
SELECT borough, {_METRICS_SQL.replace(", 6)", ", 4)")} FROM scored GROUP BY 1""",
)
def backtest_with_drivers(spark: SparkSession, sf: str) -> DataFrame:
    """All terms: lags 1, 7 and 8, lagged shocks, and two drivers."""
    series = daily_series(spark, sf).na.fill(0.0)
    metrics, _ = backtest(series, "trips", "day", ["mean_price", "max_price"], BY, shock_lags=(1, 7, 8))
    return rounded(metrics, 4, "mae", "rmse", "mape")
