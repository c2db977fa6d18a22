"""Least squares, for one model or for one model per key, and the unit-root test.

Rows never leave Spark: a fit is an aggregate of cross-products, combined in
the map tasks, and only its k x k result, one row per key, meets numpy.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .series import over

# The small solvers below travel to the tasks with the functions that call
# them, so the workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ---------------------------------------------------------------------------
# One model
# ---------------------------------------------------------------------------


def ols(
    df: DataFrame,
    y: str,
    xs: Sequence[str],
    order: str | None = None,
    keys: Sequence[str] = (),
    confidence: float = 0.95,
    diagnostics: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Ordinary least squares with a constant: coefficient table and model summary.

    Rows with a NULL are left out.  A driver that never varies says nothing
    beyond the constant: its coefficient is 0, without error or t value.
    Drivers that determine each other have no single answer; one of least size
    is given, without errors.  Both results are small: one row per coefficient
    with its interval, and one row.

    The fit is one aggregate of covariances, of fixed size.  ``diagnostics``
    adds one more over the residuals: skew, kurtosis and the Jarque-Bera test
    of normality, and with ``order`` the Durbin-Watson statistic of residuals
    that follow each other in that order; several series are told apart by
    ``keys``.  A residual's predecessor is found in a window, so a series stands
    in one task: it is a series of days, not of raw rows.
    """
    xs = list(xs)
    names = [f"_c{i}" for i in range(len(xs) + 1)]
    columns = [F.col(f"`{c}`").cast("double").alias(n) for c, n in zip([*xs, y], names)]
    rows = df.select(*columns, *[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate([*keys, *([order] if order else [])])])
    rows = rows.na.drop("any", subset=names)
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    found = rows.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(names)],
        *[F.covar_pop(names[i], names[j]).alias(f"s{i}_{j}") for i, j in pairs],
    ).first()
    n, k = found["n"], len(xs)
    if not n:
        raise ValueError("no row without NULL")
    means = np.array([found[f"m{i}"] for i in range(k + 1)])
    cov = np.zeros((k + 1, k + 1))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = found[f"s{i}_{j}"]
    scale = np.sqrt(np.maximum(np.diag(cov)[:k], 0))
    live = np.flatnonzero(scale > 1e-12 * np.abs(means[:k]))
    if not len(live):
        raise ValueError("no driver varies")

    s = scale[live]
    unit = cov[np.ix_(live, live)] / np.outer(s, s)
    inverse = np.linalg.pinv(unit, rcond=1e-12, hermitian=True) / np.outer(s, s)
    slopes = inverse @ cov[live, k]
    sse = float(n * max(cov[k, k] - slopes @ cov[live, k], 0.0))
    sst, dof = float(n * cov[k, k]), n - len(live) - 1
    estimates = [*slopes, means[k] - slopes @ means[live]]
    single = np.linalg.eigvalsh(unit)[0] > 1e-10
    spread = [*np.diag(inverse), 1 + means[live] @ inverse @ means[live]] if single and dof > 0 else [math.nan] * len(estimates)
    errors = [math.sqrt(v * sse / dof / n) if v >= 0 else math.nan for v in spread]
    reach = t_quantile(confidence, dof) if dof > 0 else math.nan
    table = {}
    for term, b, e in zip([*(xs[i] for i in live), "const"], estimates, errors):
        t = b / e if e else math.nan
        table[term] = (float(b), *map(_known, (e, t, t_p_value(t, dof) if dof > 0 else math.nan, b - reach * e, b + reach * e)))
    spark = df.sparkSession
    coefficients = spark.createDataFrame(
        [(term, *table.get(term, (0.0, None, None, None, None, None))) for term in [*xs, "const"]],
        "term string, coef double, std_err double, t double, p_value double, ci_low double, ci_high double",
    )

    m = len(live)
    r2 = 1 - sse / sst if sst > 0 else 0.0
    loglik = -n / 2 * (math.log(2 * math.pi) + math.log(sse / n) + 1) if sse > 0 else math.inf
    f_stat = (r2 / m) / ((1 - r2) / dof) if r2 < 1 and dof > 0 else math.inf
    adjusted = 1 - (1 - r2) * (n - 1) / dof if dof > 0 else None
    f_p = _incomplete_beta(dof / 2, m / 2, dof / (dof + m * f_stat)) if math.isfinite(f_stat) else 0.0
    row = [n, dof, r2, adjusted, f_stat, loglik, 2 * (m + 1) - 2 * loglik, (m + 1) * math.log(n) - 2 * loglik, f_p]
    row.append(_condition(n, means[live], cov[np.ix_(live, live)]))
    layout = (
        "n bigint, df_resid bigint, r2 double, adj_r2 double, f_stat double, log_likelihood double, "
        "aic double, bic double, f_p_value double, cond_no double"
    )
    if diagnostics:
        weights = [(names[i], float(b)) for i, b in zip(live, slopes)]
        row += _residual_tests(rows, names[k], weights, float(estimates[-1]), [f"_k{i}" for i in range(len(keys))], f"_k{len(keys)}" if order else None)
        layout += ", skew double, kurtosis double, jarque_bera double, jarque_bera_p double, durbin_watson double"
    row = [v if v is None or isinstance(v, int) else None if math.isnan(v) else float(v) for v in row]
    return coefficients, spark.createDataFrame([tuple(row)], layout)


def _known(v: float) -> float | None:
    return float(v) if math.isfinite(v) else None


def _condition(n: int, means: np.ndarray, cov: np.ndarray) -> float:
    """Condition number of the design with its constant: root of the ratio of the extreme eigenvalues of its products."""
    full = np.empty((len(means) + 1, len(means) + 1))
    full[0, 0], full[0, 1:], full[1:, 0] = 1, means, means
    full[1:, 1:] = cov + np.outer(means, means)
    values = np.linalg.eigvalsh(full * n)
    return math.sqrt(values[-1] / values[0]) if values[0] > 0 else math.inf


def _residual_tests(
    rows: DataFrame, y: str, weights: Sequence[tuple[str, float]], constant: float, keys: Sequence[str], order: str | None
) -> list[float]:
    """Skew, kurtosis, Jarque-Bera with its p-value, and Durbin-Watson, from one aggregate over the residuals."""
    fitted = sum((F.col(c) * F.lit(b) for c, b in weights), F.lit(constant))
    e = F.col("_e")
    rows = rows.select(*keys, *([order] if order else []), (F.col(y) - fitted).alias("_e"))
    step = F.lit(None).cast("double")
    if order:
        rows = rows.withColumn("_step", e - F.lag(e, 1).over(over(list(keys), order)))
        step = F.col("_step")
    powers = [F.avg(F.pow(e, F.lit(p))).alias(f"m{p}") for p in (2, 3, 4)]
    r = rows.agg(F.count(e).alias("n"), *powers, F.sum(e * e).alias("ss"), F.sum(step * step).alias("steps")).first()
    if not r["m2"]:
        return [math.nan] * 5
    skew, kurtosis = r["m3"] / r["m2"] ** 1.5, r["m4"] / r["m2"] ** 2
    jb = r["n"] / 6 * (skew**2 + (kurtosis - 3) ** 2 / 4)
    dw = r["steps"] / r["ss"] if r["steps"] is not None else math.nan
    return [skew, kurtosis, jb, math.exp(-jb / 2), dw]


def _incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function, by its continued fraction (Lentz's evaluation)."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _incomplete_beta(b, a, 1 - x)
    tiny, c, d = 1e-300, 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    value = d
    for i in range(1, 10_000):
        last = value
        for term in (i * (b - i) * x / ((a + 2 * i - 1) * (a + 2 * i)), -(a + i) * (a + b + i) * x / ((a + 2 * i) * (a + 2 * i + 1))):
            d, c = 1 + term * d, 1 + term / c
            d, c = 1 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
            value *= d * c
        if abs(value - last) < 1e-15 * abs(value):
            break
    front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    return math.exp(front) * value / a


def chi2_p_value(value: float, dof: int) -> float:
    """Probability of a chi-squared value at least as large: the tail for one or two degrees, and a term for every two more."""
    if math.isnan(value) or value < 0:
        return math.nan
    half = value / 2
    tail, a = (math.exp(-half), 1.0) if dof % 2 == 0 else (math.erfc(math.sqrt(half)), 0.5)
    while a < dof / 2:
        tail += math.exp(a * math.log(half) - half - math.lgamma(a + 1)) if half > 0 else 0.0
        a += 1
    return min(tail, 1.0)


def t_p_value(t: float, dof: int) -> float:
    """Probability of a t value at least as far from 0."""
    return math.nan if math.isnan(t) else _incomplete_beta(dof / 2, 0.5, dof / (dof + t * t))


def t_quantile(confidence: float, dof: int) -> float:
    """The t value within which ``confidence`` of the distribution lies."""
    low, high = 0.0, 1.0
    while t_p_value(high, dof) > 1 - confidence:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if t_p_value(mid, dof) > 1 - confidence else (low, mid)
    return (low + high) / 2


def simple_ols(df: DataFrame, y: str, x: str, keys: Sequence[str] = ()) -> DataFrame:
    """Slope, intercept and R2 of y on one driver, per key, in one pass."""
    a, b = F.col(y).cast("double"), F.col(x).cast("double")
    return df.groupBy(*keys).agg(
        F.regr_count(a, b).alias("n"),
        F.regr_slope(a, b).alias("slope"),
        F.regr_intercept(a, b).alias("intercept"),
        F.regr_r2(a, b).alias("r2"),
    )


# ---------------------------------------------------------------------------
# One model per key
# ---------------------------------------------------------------------------

_DOUBLES = T.ArrayType(T.DoubleType())
FIT = (
    T.StructType()
    .add("intercept", T.DoubleType())
    .add("coef", _DOUBLES)
    .add("t", _DOUBLES)
    .add("sse", T.DoubleType())
    .add("r2", T.DoubleType())
)


def cross_products(
    df: DataFrame, y: str, xs: Sequence[str], keys: Sequence[str], extra: Sequence[Column] = (), series: bool = False
) -> DataFrame:
    """Per key: row count, means and mean centred cross-products of (xs, y).

    Means are found first and products of deviations averaged second, which
    keeps large levels from swallowing small variation.  Both work on vectors,
    so the plan does not grow with the number of columns.  Rows with a NULL are
    left out.

    Groups may be of any size: both steps combine rows in the map tasks.  With
    ``series`` each group is a series of one row per day, and its means come
    from a window, which reads the input once instead of twice.
    """
    cols = [*xs, y]
    vec = F.array(*[F.col(c).cast("double") for c in cols])
    rows = df.na.drop("any", subset=cols)
    if series:
        w = over(keys)
        means = F.array(*[F.avg(F.col(c).cast("double")).over(w) for c in cols])
        rows = rows.withColumns({"_v": vec, "_m": means, "_n": F.count(F.lit(1)).over(w)})
    else:
        rows = rows.withColumn("_v", vec)
        centre = vector_to_array(Summarizer.mean(array_to_vector(F.col("_v"))))
        totals = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), centre.alias("_m"))
        rows = rows.join(totals, list(keys))
    rows = rows.withColumn("_d", F.zip_with("_v", "_m", lambda a, m: a - m))
    return _mean_products(rows, "_d", keys, F.first("_n").alias("n"), F.first("_m").alias("means"), *extra)


def _mean_products(rows: DataFrame, vec: str, keys: Sequence[str], *extra: Column) -> DataFrame:
    """Per key the mean of v v', its upper triangle row by row as one flat array."""
    v = F.col(vec)
    upper = F.flatten(F.transform(v, lambda a, i: F.transform(F.slice(v, i + 1, F.size(v)), lambda b: a * b)))
    mean = vector_to_array(Summarizer.mean(array_to_vector(F.col("_o"))))
    return rows.withColumn("_o", upper).groupBy(*keys).agg(mean.alias("products"), *extra)


def _square(upper) -> np.ndarray:
    """Symmetric matrix from its upper triangle."""
    size = (math.isqrt(8 * len(upper) + 1) - 1) // 2
    m = np.zeros((size, size))
    m[np.triu_indices(size)] = upper
    return m + np.triu(m, 1).T


def _moments(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and centred products from the mean products of (1, xs, y)."""
    means = p[0, 1:]
    return means, p[1:, 1:] - np.outer(means, means)


def _centred(upper) -> tuple[np.ndarray, np.ndarray]:
    return _moments(_square(upper))


def _solve(n: int, means: np.ndarray, products: np.ndarray) -> tuple:
    """Coefficients from centred moments; columns without variation get 0."""
    k = len(means) - 1
    m = products * n
    a, b, syy = m[:k, :k], m[:k, k], m[k, k]
    scale = np.sqrt(np.diag(a))
    live = scale > 1e-12 * np.abs(means[:k]) * math.sqrt(max(n, 1))
    coef, se = np.zeros(k), np.full(k, np.nan)
    dof = n - int(live.sum()) - 1
    if live.any() and dof >= 0:
        s = scale[live]
        inv = np.linalg.pinv(a[np.ix_(live, live)] / np.outer(s, s), rcond=1e-12, hermitian=True)
        coef[live] = inv @ (b[live] / s) / s
        sse = max(syy - coef @ b, 0.0)
        if dof > 0:
            se[live] = np.sqrt(np.maximum(np.diag(inv), 0) * sse / dof) / s
    else:
        sse = syy
    if dof < 0:
        return None, None, None, None, None
    with np.errstate(divide="ignore", invalid="ignore"):
        t = coef / se
    r2 = 1 - sse / syy if syy > 0 else None
    return float(means[k] - coef @ means[:k]), coef.tolist(), _finite(t), float(sse), r2


def _finite(values: np.ndarray) -> list:
    return [float(v) if math.isfinite(v) else None for v in values]


@F.pandas_udf(FIT)
def _fit(n: pd.Series, means: pd.Series, products: pd.Series) -> pd.DataFrame:
    rows = [_solve(i, np.asarray(m, float), _square(p)) for i, m, p in zip(n, means, products)]
    return pd.DataFrame(rows, columns=["intercept", "coef", "t", "sse", "r2"])


def fit_by_key(
    df: DataFrame, y: str, xs: Sequence[str], keys: Sequence[str], extra: Sequence[Column] = (), series: bool = False
) -> DataFrame:
    """One regression per key: n, intercept, coef, t, sse, r2.

    A key with fewer rows than coefficients has a NULL fit.  ``series`` is as
    in ``cross_products``; ``extra`` adds aggregates of the same rows.
    """
    sums = cross_products(df, y, xs, keys, extra, series)
    others = [c for c in sums.columns if c not in ("means", "products")]
    return sums.select(*others, _fit("n", "means", "products").alias("_f")).select(*others, "_f.*")


@F.pandas_udf(FIT)
def _fit_vectors(n: pd.Series, products: pd.Series) -> pd.DataFrame:
    rows = [_solve(i, *_centred(p)) for i, p in zip(n, products)]
    return pd.DataFrame(rows, columns=["intercept", "coef", "t", "sse", "r2"])


def fit_vectors(rows: DataFrame, vec: str, keys: Sequence[str], *extra: Column) -> DataFrame:
    """``fit_by_key`` for many drivers, given as arrays (1, drivers, y) already near zero mean."""
    sums = _mean_products(rows, vec, keys, F.count(F.lit(1)).alias("n"), *extra)
    others = [c for c in sums.columns if c != "products"]
    return sums.select(*others, _fit_vectors("n", "products").alias("_f")).select(*others, "_f.*")


def linear_score(xs: Sequence[str], coef: str = "coef", first: int = 0) -> Column:
    """Sum of drivers times their coefficients, ``first`` being the place of the first one.

    The row has been joined to its key's fit.  NULL where a driver is.
    """
    terms = [F.col(x).cast("double") * F.get(F.col(coef), first + i) for i, x in enumerate(xs)]
    return sum(terms, F.lit(0.0))


# ---------------------------------------------------------------------------
# Unit-root test
# ---------------------------------------------------------------------------

# Critical values of the test with constant as b0 + b1/n + b2/n^2
# + b3/n^3 (MacKinnon 2010), and the polynomials whose normal probability is
# the p-value below and above the given split (MacKinnon 1994).
ADF_CRITICAL = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}
ADF_P_LOW = (2.1659, 1.4412, 0.038269)
ADF_P_HIGH = (1.7339, 0.93202, -0.12745, -0.010368)
ADF_P_MIN, ADF_P_SPLIT, ADF_P_MAX = -18.83, -1.61, 2.74


def _adf_p(stat: float) -> float:
    if stat > ADF_P_MAX:
        return 1.0
    if stat < ADF_P_MIN:
        return 0.0
    powers = ADF_P_LOW if stat <= ADF_P_SPLIT else ADF_P_HIGH
    z = sum(c * stat**i for i, c in enumerate(powers))
    return 0.5 * math.erfc(-z / math.sqrt(2))


ADF = (
    T.StructType()
    .add("adf_stat", T.DoubleType())
    .add("used_lag", T.IntegerType())
    .add("n_obs", T.LongType())
    .add("p_value", T.DoubleType())
)


def _errors_by_size(products: np.ndarray) -> list[float]:
    """Squared error left by the first 1, 2, ... drivers of centred products (drivers, y), by one sweep.

    A driver that the ones before it determine leaves the error as it is.
    """
    a = products.copy()
    scale, out = np.diag(products).copy(), []
    for j in range(len(a) - 1):
        if a[j, j] > 1e-12 * scale[j]:
            a -= np.outer(a[:, j], a[j]) / a[j, j]
        out.append(max(a[-1, -1], 0.0))
    return out


def _unit_root(n: int, products, early, limit: int) -> tuple:
    """Statistic, lagged differences used, observations and p-value of one series.

    ``products`` are means over the ``n`` rows that every lag count can use;
    ``early`` holds the rows before them, (place, vector), which fewer lags
    can use as well.
    """
    if n < 1:
        return None, None, None, None
    means, centred = _centred(products)
    best = (math.inf, 0)
    for lags, mean in enumerate(_errors_by_size(centred)[: limit + 1]):
        if n < lags + 2:
            break
        aic = (n * math.log(mean) if mean > 0 else -math.inf) + 2 * (lags + 2)
        best = min(best, (aic, lags))
    used = best[1]
    keep = [*range(used + 2), len(means)]
    more = [np.asarray(r["v"], float)[[*range(used + 2), -1]] for r in early if r["i"] >= used + 2]
    total = _square(products)[np.ix_(keep, keep)] * n + sum((np.outer(v, v) for v in more), np.zeros((used + 3, used + 3)))
    count = n + len(more)
    means, centred = _moments(total / count)
    t = _solve(count, means, centred)[2]
    stat = t[0] if t else None
    return stat, used, count, None if stat is None else _adf_p(stat)


@F.pandas_udf(ADF)
def _unit_roots(n: pd.Series, products: pd.Series, early: pd.Series, limit: pd.Series) -> pd.DataFrame:
    rows = [_unit_root(int(a), b, c, int(d)) for a, b, c, d in zip(n, products, early, limit)]
    return pd.DataFrame(rows, columns=["adf_stat", "used_lag", "n_obs", "p_value"]).astype({"used_lag": "Int32", "n_obs": "Int64"})


def default_max_lag(n: Column) -> Column:
    """Longest lag tried for n observations: 12 (n/100)^(1/4), rounded up, within n/2 - 2."""
    wide = F.ceil(F.lit(12.0) * F.pow(n / F.lit(100.0), F.lit(0.25)))
    return F.greatest(F.least(wide, F.floor(n / 2) - 2), F.lit(0)).cast("int")


#: Earlier differences a row carries; the default of a series of 1.2 million observations needs no more.
WIDEST_LAG = 128


def adf_stat(
    df: DataFrame, y: str, t: str, keys: Sequence[str] = (), max_lag: int | None = None
) -> DataFrame:
    """Augmented Dickey-Fuller test with constant, for each series.

    Per key: statistic, p-value, lagged differences used (least AIC up to the
    default for the series' length, or up to ``max_lag``), observations of the
    final regression, and critical values.

    All series take one aggregate: cross-products of the rows that every lag
    count can use, and the few rows before them.  One sweep over a series'
    products yields the error of every lag count in turn; the chosen one is
    then fitted on all rows it allows.  A default beyond ``WIDEST_LAG`` fails
    the job; name ``max_lag`` for such series.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(t), F.col(y).cast("double").alias("_y")).filter(F.col("_y").isNotNull())
    if not keys:
        rows, keys = rows.withColumn("_series", F.lit(0)), ["_series"]
    widest = WIDEST_LAG if max_lag is None else max_lag

    # Earlier differences are kept as one array, so the plan has the same size
    # for any number of lags.  The level is centred, and differences are by
    # nature, so the plain products below lose no digits.
    w, whole = over(keys, t), over(keys)
    limit = default_max_lag(F.count(F.lit(1)).over(whole))
    if max_lag is None:
        limit = F.when(limit <= widest, limit).otherwise(F.raise_error(F.lit(f"name max_lag: more than {widest} lags by default")).cast("int"))
    base = rows.withColumns(
        {
            "_i": F.row_number().over(w),
            "_limit": F.least(limit, F.lit(widest)),
            "_before": F.lag("_y", 1).over(w),
            "_mean": F.avg("_y").over(whole),
        }
    )
    base = base.select(
        *keys, F.col(t), "_i", "_limit", (F.col("_before") - F.col("_mean")).alias("_level"),
        (F.col("_y") - F.col("_before")).alias("_diff"),
    )
    earlier = F.reverse(F.collect_list("_diff").over(w.rowsBetween(-max(widest, 1), -1)))
    base = base.withColumn("_lags", F.slice(earlier, 1, F.col("_limit"))).filter("_i > 1")

    # (1, level, earlier differences, difference); a row that has not all of them weighs nothing in the products
    vec = F.concat(F.array(F.lit(1.0), F.col("_level")), F.col("_lags"), F.array(F.col("_diff")))
    full = F.col("_i") >= F.col("_limit") + 2
    base = base.select(*keys, "_i", "_limit", vec.alias("_v"), full.alias("_full"))
    v = F.col("_v")
    upper = F.flatten(F.transform(v, lambda a, i: F.transform(F.slice(v, i + 1, F.size(v)), lambda b: a * b)))
    size = F.col("_limit") + 3
    blank = F.array_repeat(F.lit(0.0), (size * (size + 1) / 2).cast("int"))
    base = base.withColumns({"_o": F.when(F.col("_full"), upper).otherwise(blank), "_w": F.col("_full").cast("double")})
    sums = base.groupBy(*keys).agg(
        F.count_if("_full").alias("n"),
        vector_to_array(Summarizer.mean(array_to_vector(F.col("_o")), F.col("_w"))).alias("products"),
        F.collect_list(F.when(~F.col("_full"), F.struct(F.col("_i").alias("i"), v.alias("v")))).alias("early"),
        F.first("_limit").alias("limit"),
    )
    out = sums.select(*keys, _unit_roots("n", "products", "early", "limit").alias("_a")).select(*keys, "_a.*")
    crit = {
        f"crit_{name[:-1]}": sum((F.lit(b) / F.pow("n_obs", F.lit(i)) for i, b in enumerate(bs) if i), F.lit(bs[0]))
        for name, bs in ADF_CRITICAL.items()
    }
    return out.select(*keys, "adf_stat", "used_lag", "n_obs", "p_value").withColumns(crit).drop("_series")
