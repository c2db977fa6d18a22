"""Models against plain numpy on small series."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanflow.operators.forecast import backtest, forecast_direct, seasonal_arx, seasonal_naive, seasonal_summary
from urbanflow.operators.regression import adf_stat, chi2_p_value, fit_by_key, ols, simple_ols, t_p_value, t_quantile

D0 = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    out = {}
    for key, n in (("a", 90), ("b", 70)):
        x1, x2 = rng.normal(1000, 5, n), rng.normal(0, 1, n)
        y = np.zeros(n)
        for i in range(n):
            back = y[i - 1] if i else 0
            week = y[i - 7] if i >= 7 else 0
            y[i] = 50 + 0.4 * back + 0.3 * week + 0.05 * x1[i] - 2 * x2[i] + rng.normal(0, 2)
        out[key] = (y, x1, x2)
    return out


@pytest.fixture(scope="module")
def frame(spark, data):
    rows = [
        (k, D0 + dt.timedelta(days=i), float(y[i]), float(a[i]), float(b[i]))
        for k, (y, a, b) in data.items()
        for i in range(len(y))
    ]
    return spark.createDataFrame(rows, "k string, day date, y double, x1 double, x2 double")


def least_squares(y, cols):
    x = np.column_stack([np.ones(len(y)), *cols])
    coef, *_ = np.linalg.lstsq(x, y, rcond=None)
    resid = y - x @ coef
    sse = resid @ resid
    se = np.sqrt(np.diag(np.linalg.pinv(x.T @ x)) * sse / (len(y) - x.shape[1]))
    return coef, se, sse


def test_ols(frame, data):
    y, a, b = (np.concatenate([data[k][i] for k in data]) for i in range(3))
    coef, se, sse = least_squares(y, [a, b])
    table, summary = ols(frame, "y", ["x1", "x2"])
    got = {r["term"]: r for r in table.collect()}
    for i, term in enumerate(["const", "x1", "x2"]):
        assert got[term]["coef"] == pytest.approx(coef[i], rel=1e-6)
        assert got[term]["std_err"] == pytest.approx(se[i], rel=1e-6)
        assert got[term]["t"] == pytest.approx(coef[i] / se[i], rel=1e-6)
        assert 0 <= got[term]["p_value"] <= 1
    (s,) = summary.collect()
    n, r2 = len(y), 1 - sse / ((y - y.mean()) ** 2).sum()
    assert s["n"] == n and s["df_resid"] == n - 3 and s["r2"] == pytest.approx(r2)
    assert s["adj_r2"] == pytest.approx(1 - (1 - r2) * (n - 1) / (n - 3))
    assert s["f_stat"] == pytest.approx((r2 / 2) / ((1 - r2) / (n - 3)))
    llf = -n / 2 * (math.log(2 * math.pi * sse / n) + 1)
    assert s["log_likelihood"] == pytest.approx(llf) and s["aic"] == pytest.approx(6 - 2 * llf)


def test_full_summary(frame, data):
    y, a, b = (np.concatenate([data[k][i] for k in data]) for i in range(3))
    x = np.column_stack([np.ones(len(y)), a, b])
    coef, se, sse = least_squares(y, [a, b])
    e = y - x @ coef
    table, summary = ols(frame, "y", ["x1", "x2"], order="day", keys=["k"], diagnostics=True)
    s = summary.first()
    steps = sum(float((np.diff(part) ** 2).sum()) for part in np.split(e, [90]))
    assert s["durbin_watson"] == pytest.approx(steps / sse, rel=1e-6)
    m2, m3, m4 = ((e**p).mean() for p in (2, 3, 4))
    assert (s["skew"], s["kurtosis"]) == (pytest.approx(m3 / m2**1.5, rel=1e-6), pytest.approx(m4 / m2**2, rel=1e-6))
    jb = len(y) / 6 * (s["skew"] ** 2 + (s["kurtosis"] - 3) ** 2 / 4)
    assert (s["jarque_bera"], s["jarque_bera_p"]) == (pytest.approx(jb), pytest.approx(math.exp(-jb / 2)))
    assert s["cond_no"] == pytest.approx(np.linalg.cond(x), rel=1e-5)
    for r in table.collect():
        assert r["ci_low"] < r["coef"] < r["ci_high"]
        assert (r["ci_high"] - r["ci_low"]) / 2 / r["std_err"] == pytest.approx(1.975, abs=2e-3)  # t of 157 degrees
    assert s["f_p_value"] == pytest.approx((1 + 2 * s["f_stat"] / 157) ** (-157 / 2))  # exact for two drivers


def test_t_distribution():
    """Published table values of the t distribution."""
    for dof, confidence, value in ((1, 0.95, 12.7062), (5, 0.95, 2.5706), (10, 0.99, 3.1693), (30, 0.9, 1.6973), (1000, 0.95, 1.9623)):
        assert t_quantile(confidence, dof) == pytest.approx(value, abs=6e-5)
        assert t_p_value(value, dof) == pytest.approx(1 - confidence, abs=2e-5)
        assert t_p_value(-value, dof) == t_p_value(value, dof)
    assert t_p_value(0.0, 7) == 1 and t_p_value(1.0, 1) == pytest.approx(0.5)


def test_perfect_and_tiny_fits(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(6)], "x double, y double")
    table, summary = ols(df, "y", ["x"], diagnostics=True)
    got = {r["term"]: r["coef"] for r in table.collect()}
    assert got["x"] == pytest.approx(2) and got["const"] == pytest.approx(1) and summary.first()["r2"] == pytest.approx(1)
    table, summary = ols(df.limit(2), "y", ["x"])
    assert table.first()["std_err"] is None and summary.first()["adj_r2"] is None
    with pytest.raises(ValueError):
        ols(df.limit(0), "y", ["x"])


def test_ols_with_idle_and_redundant_drivers(frame, data):
    idle = frame.withColumn("flat", F.lit(1.0))
    table, summary = ols(idle, "y", ["x1", "flat", "x2"])
    plain, _ = ols(frame, "y", ["x1", "x2"])
    got = {r["term"]: r for r in table.collect()}
    assert [r["term"] for r in table.collect()] == ["x1", "flat", "x2", "const"]
    assert (got["flat"]["coef"], got["flat"]["t"]) == (0.0, None) and summary.first()["df_resid"] == 157
    for r in plain.collect():
        assert got[r["term"]]["coef"] == pytest.approx(r["coef"]) and got[r["term"]]["t"] == pytest.approx(r["t"])
    twin = frame.withColumn("x3", 2 * F.col("x2"))
    tangled = {r["term"]: r["coef"] for r in ols(twin, "y", ["x2", "x3"])[0].collect()}
    alone = {r["term"]: r["coef"] for r in ols(frame, "y", ["x2"])[0].collect()}
    assert tangled["x2"] + 2 * tangled["x3"] == pytest.approx(alone["x2"], rel=1e-3)


@pytest.mark.parametrize("as_series", [False, True])
def test_fit_by_key(frame, data, as_series):
    flat = frame.withColumn("flat", F.lit(3.0))
    for r in fit_by_key(flat, "y", ["x1", "flat", "x2"], ["k"], series=as_series).collect():
        y, a, b = data[r["k"]]
        coef, se, sse = least_squares(y, [a, b])
        assert r["n"] == len(y) and r["intercept"] == pytest.approx(coef[0], rel=1e-6)
        assert r["coef"] == pytest.approx([coef[1], 0, coef[2]], rel=1e-6) and r["sse"] == pytest.approx(sse)
        assert r["t"][0] == pytest.approx(coef[1] / se[1]) and r["t"][1] is None


def test_fit_by_key_without_enough_rows(frame):
    few = frame.filter(F.col("day") < F.lit(D0 + dt.timedelta(days=2)))
    assert all(r["coef"] is None for r in fit_by_key(few, "y", ["x1", "x2"], ["k"]).collect())


def test_simple_ols(frame, data):
    for r in simple_ols(frame, "y", "x2", ["k"]).collect():
        coef, _, _ = least_squares(data[r["k"]][0], [data[r["k"]][2]])
        assert (r["intercept"], r["slope"]) == pytest.approx(tuple(coef))


def adf_by_hand(y, max_lag=None):
    n = len(y)
    limit = max(min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2), 0)
    limit = limit if max_lag is None else min(limit, max_lag)
    d = np.diff(y)

    def fit(lags, first):
        rows = range(first, len(d))
        cols = [[y[i] for i in rows], *[[d[i - k] for i in rows] for k in range(1, lags + 1)]]
        return least_squares(d[first:], cols), len(rows)

    aic = []
    for lags in range(limit + 1):
        (_, _, sse), m = fit(lags, limit)
        aic.append((m * math.log(sse / m) + 2 * (lags + 2), lags))
    used = min(aic)[1]
    (coef, se, _), m = fit(used, used)
    return coef[1] / se[1], used, m


@pytest.mark.parametrize("max_lag", [None, 3, 0])
def test_adf(frame, data, max_lag):
    rows = adf_stat(frame, "y", "day", ["k"], max_lag).collect()
    assert len(rows) == 2
    for r in rows:
        stat, used, n = adf_by_hand(data[r["k"]][0], max_lag)
        assert (r["used_lag"], r["n_obs"]) == (used, n)
        assert r["adf_stat"] == pytest.approx(stat, rel=1e-7)
        assert r["crit_1"] < r["crit_5"] < r["crit_10"] and 0 <= r["p_value"] <= 1


def test_adf_of_one_series_and_p_value(spark, data):
    walk = np.cumsum(np.random.default_rng(3).normal(size=120))
    df = spark.createDataFrame([(D0 + dt.timedelta(days=i), float(v)) for i, v in enumerate(walk)], "day date, y double")
    (r,) = adf_stat(df, "y", "day").collect()
    assert r["adf_stat"] == pytest.approx(adf_by_hand(walk)[0], rel=1e-7)
    assert r["p_value"] > 0.05 and (r["adf_stat"] < r["crit_5"]) == (r["p_value"] < 0.05)


def test_seasonal_summary(frame, data):
    fits, predicted = seasonal_arx(frame, "y", "day", ["x1", "x2"], ["k"])
    got = {r["k"]: r for r in seasonal_summary(fits, predicted, "y", "day", ["k"], lags=5).collect()}
    for key, (y, a, b) in data.items():
        x = np.column_stack([np.ones(len(y) - 8), *(y[8 - k : len(y) - k] for k in (1, 7, 8)), a[8:], b[8:]])
        coef, *_ = np.linalg.lstsq(x, y[8:], rcond=None)
        e = y[8:] - x @ coef
        n, r = len(e), got[key]
        ll = -n / 2 * (math.log(2 * math.pi * (e @ e) / n) + 1)
        assert (r["n"], r["terms"]) == (n, 6) and r["log_likelihood"] == pytest.approx(ll)
        assert (r["aic"], r["bic"]) == (pytest.approx(12 - 2 * ll), pytest.approx(6 * math.log(n) - 2 * ll))
        e = e - e.mean()
        acf = [float(e[k:] @ e[:-k] / (e @ e)) for k in range(1, 6)]
        assert r["autocorrelations"] == pytest.approx(acf, abs=1e-8)
        q = n * (n + 2) * sum(v * v / (n - k) for k, v in enumerate(acf, 1))
        assert r["ljung_box"] == pytest.approx(q) and r["ljung_box_p"] == pytest.approx(chi2_p_value(q, 5))
    one, _ = seasonal_arx(frame.where("k = 'a'").drop("k"), "y", "day"), None
    assert seasonal_summary(*one, "y", "day").count() == 1


def test_chi2():
    """Published table values."""
    for dof, value, p in ((1, 3.8415, 0.05), (2, 5.9915, 0.05), (5, 11.0705, 0.05), (10, 23.2093, 0.01), (7, 14.0671, 0.05)):
        assert chi2_p_value(value, dof) == pytest.approx(p, abs=2e-6)
    assert chi2_p_value(0.0, 3) == 1


def test_seasonal_model(frame, data):
    fits, predicted = seasonal_arx(frame, "y", "day", ["x1", "x2"], ["k"])
    coefs = {r["k"]: r for r in fits.collect()}
    rows = predicted.orderBy("k", "day").collect()
    assert len(rows) == 160
    for key, (y, a, b) in data.items():
        x = [y[7:-1], y[1:-7], y[:-8], a[8:], b[8:]]
        coef, _, _ = least_squares(y[8:], x)
        assert coefs[key]["coef"] == pytest.approx(list(coef[1:]), rel=1e-5)
        got = [r["predicted"] for r in rows if r["k"] == key]
        assert got[:8] == [None] * 8
        assert got[8:] == pytest.approx(list(np.column_stack([np.ones(len(y) - 8), *x]) @ coef))


def test_seasonal_model_with_shocks(frame):
    _, plain = seasonal_arx(frame, "y", "day", ["x2"], ["k"], lags=(1, 7))
    _, rich = seasonal_arx(frame, "y", "day", ["x2"], ["k"], lags=(1, 7), shock_lags=(1, 7))

    def sse(df):
        late = df.filter(F.col("day") > F.lit(D0 + dt.timedelta(days=25)))
        return late.agg(F.sum(F.pow(F.col("y") - F.col("predicted"), F.lit(2)))).first()[0]

    assert rich.count() == 160 and sse(rich) < sse(plain) * 1.02


def test_backtest_uses_no_test_demand(spark, frame, data):
    metrics, forecasts = backtest(frame, "y", "day", ["x1", "x2"], ["k"], lags=(1, 7))
    rows = forecasts.orderBy("k", "day").collect()
    for key, (y, a, b) in data.items():
        n = int(len(y) * 0.7)
        coef, _, _ = least_squares(y[7:n], [y[6 : n - 1], y[: n - 7], a[7:n], b[7:n]])
        path = list(y[:n])
        for i in range(n, len(y)):
            path.append(coef @ [1, path[i - 1], path[i - 7], a[i], b[i]])
        assert [r["predicted"] for r in rows if r["k"] == key] == pytest.approx(path[n:])
        m = metrics.filter(F.col("k") == key).first()
        assert m["n"] == len(y) - n and m["mae"] == pytest.approx(np.abs(np.array(path[n:]) - y[n:]).mean())

    cut = frame.withColumn("y", F.when(F.col("day") >= F.lit(D0 + dt.timedelta(days=63)), -1e6).otherwise(F.col("y")))
    _, blind = backtest(cut.filter("k = 'a'"), "y", "day", ["x1", "x2"], ["k"], lags=(1, 7))
    assert [r["predicted"] for r in blind.orderBy("day").collect()] == pytest.approx([r["predicted"] for r in rows if r["k"] == "a"])


def test_backtest_with_shocks_and_one_series(frame):
    one = frame.filter("k = 'a'").drop("k")
    metrics, forecasts = backtest(one, "y", "day", ["x2"], lags=(1, 7), shock_lags=(1,))
    assert forecasts.count() == 28 and metrics.first()["mae"] < 10 and forecasts.filter("predicted IS NULL").count() == 0


def test_direct_forecast(spark, frame, data):
    got = {(r["k"], r["step"]): r for r in forecast_direct(frame, "y", "day", ["x1"], ["k"]).collect()}
    assert len(got) == 28
    for key, (y, a, _) in data.items():
        n = len(y)
        for h in range(1, 15):
            at = range(7, n - h)
            coef, _, _ = least_squares(
                y[7 + h :], [[y[i] for i in at], [y[i - 7 + h % 7] for i in at], [a[i + h] for i in at]]
            )
            expected = coef @ [1, y[n - 1], y[n - 1 - 7 + h % 7], a[n - 14 + h - 1]]
            assert got[key, h]["forecast"] == pytest.approx(expected)
            assert got[key, h]["origin"] == D0 + dt.timedelta(days=n - 1)
    future = spark.createDataFrame([(k, h, 1000.0) for k in "ab" for h in range(1, 4)], "k string, step int, x1 double")
    assert forecast_direct(frame, "y", "day", ["x1"], ["k"], future_exog=future).count() == 6


def test_naive(frame, data):
    got = [r["predicted"] for r in seasonal_naive(frame, "y", "day", ["k"]).filter("k = 'b'").orderBy("day").collect()]
    assert got[:7] == [None] * 7 and got[7:] == pytest.approx(list(data["b"][0][:-7]))
