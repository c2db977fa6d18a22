import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from urbanflow.operators.correlation import corr_matrix, forecast_metrics
from urbanflow.operators.predicates import drop_nulls
from urbanflow.operators.series import decompose_additive, densify, last_n, resample_daily, time_split, with_lags
from urbanflow.session import stage

D0 = dt.date(2024, 1, 1)


def day(i):
    return D0 + dt.timedelta(days=i)


def series(spark, values, key="a"):
    return spark.createDataFrame([(key, day(i), v) for i, v in enumerate(values)], "k string, day date, y double")


def test_densify(spark):
    df = spark.createDataFrame([("a", day(0), 1, 1.0), ("a", day(3), 2, 2.0), ("b", day(5), 3, None)], "k string, day date, n int, m double")
    got = [tuple(r) for r in densify(df, "day", ["k"], zero=["n"]).orderBy("k", "day").collect()]
    assert got == [
        ("a", day(0), 1, 1.0),
        ("a", day(1), 0, None),
        ("a", day(2), 0, None),
        ("a", day(3), 2, 2.0),
        ("b", day(5), 3, None),
    ]


def test_resample(spark):
    data = [("2024-01-01 05:00:00", 1, 2.0, 1), ("2024-01-01 06:00:00", 2, None, 0), ("2024-01-03 01:00:00", None, None, None), (None, 9, 9.0, 9)]
    df = spark.createDataFrame(data, "t string, n int, m double, f int").withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = resample_daily(df, "t", {"n": "sum", "m": "mean", "f": "max"})
    assert [tuple(r) for r in got.orderBy("day").collect()] == [(day(0), 3, 2.0, 1), (day(1), 0, None, None), (day(2), 0, None, None)]
    assert drop_nulls(got).count() == 1
    sparse = resample_daily(df, "t", {"n": "count"}, fill_gaps=False)
    assert [tuple(r) for r in sparse.orderBy("day").collect()] == [(day(0), 2), (day(2), 0)]


@pytest.mark.parametrize("period", [7, 4])
def test_decomposition_against_loops(spark, period):
    rng = random.Random(period)
    y = [rng.random() * 10 + i for i in range(31)]
    half = period // 2
    trend = []
    for i in range(len(y)):
        if i < half or i + half >= len(y):
            trend.append(None)
        elif period % 2:
            trend.append(sum(y[i - half : i + half + 1]) / period)
        else:
            trend.append((sum(y[i - half + 1 : i + half]) + (y[i - half] + y[i + half]) / 2) / period)
    means = []
    for p in range(period):
        d = [a - b for a, b in list(zip(y, trend))[p::period] if b is not None]
        means.append(sum(d) / len(d))
    centre = sum(means) / period
    df = series(spark, y).unionByName(series(spark, [1.0, 2.0, 3.0], "short"))
    rows = decompose_additive(df, "y", "day", ["k"], period).orderBy("k", "day").collect()
    for i, r in enumerate(rows[: len(y)]):
        assert r["seasonal"] == pytest.approx(means[i % period] - centre)
        assert (r["trend"] is None) == (trend[i] is None)
        if trend[i] is not None:
            assert r["trend"] == pytest.approx(trend[i])
            assert r["trend"] + r["seasonal"] + r["resid"] == pytest.approx(y[i])
    assert all(r["trend"] is None and r["seasonal"] is None and r["resid"] is None for r in rows[len(y) :])


def test_decomposition_shuffles_each_series_once(spark, plan):
    text = plan(decompose_additive(series(spark, [1.0] * 20), "y", "day", ["k"]))
    assert text.count("Exchange hashpartitioning") == 1


def test_staged_series_are_not_recomputed(spark, tmp_path, plan):
    series(spark, [1.0, 2.0, 3.0]).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s")).groupBy("k", "day").agg(F.sum("y").alias("y"))
    staged = stage(stored)
    assert "HashAggregate" in plan(stored) and "HashAggregate" not in plan(staged)
    assert sorted(map(tuple, staged.collect())) == sorted(map(tuple, stored.collect()))


def test_lags_and_splits(spark):
    df = series(spark, [1.0, 4.0, 9.0]).unionByName(series(spark, [float(i) for i in range(10)], "b"))
    got = with_lags(df, "y", "day", [1, 2], ["k"], difference=True).filter("k = 'a'").orderBy("day").collect()
    assert [(r["y_lag1"], r["y_lag2"], r["y_diff"]) for r in got] == [(None, None, None), (1.0, None, 3.0), (4.0, 1.0, 5.0)]
    parts = time_split(df, "day", 0.7, ["k"]).groupBy("k", "part").count().collect()
    assert {(r["k"], r["part"]): r["count"] for r in parts} == {("a", "train"): 2, ("a", "test"): 1, ("b", "train"): 7, ("b", "test"): 3}
    assert [r["y"] for r in last_n(df, "day", 2, ["k"]).orderBy("k", "day").collect()] == [4.0, 9.0, 8.0, 9.0]
    assert [r["y"] for r in last_n(df.filter("k = 'b'"), "day", 2).orderBy("day").collect()] == [8.0, 9.0]


def test_correlations(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 5.9, 5.0), (None, 7.0, 5.0)], "a double, b double, c double")
    got = {(r["var_x"], r["var_y"]): r["corr"] for r in corr_matrix(df, ["a", "b", "c"]).collect()}
    assert len(got) == 9 and got["a", "c"] is None and got["c", "c"] is None
    assert got["a", "b"] == got["b", "a"] == pytest.approx(df.na.drop().corr("a", "b"))
    assert got["a", "a"] == pytest.approx(1.0)


def test_metrics(spark):
    df = spark.createDataFrame([(2.0, 1.0), (0.0, 3.0), (4.0, 4.0), (None, 1.0), (1.0, None)], "y double, p double")
    (r,) = forecast_metrics(df, "y", "p").collect()
    assert r["n"] == 3 and r["mae"] == pytest.approx(4 / 3) and r["rmse"] == pytest.approx((10 / 3) ** 0.5)
    assert r["mape"] == pytest.approx(25.0)
