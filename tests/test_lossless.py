"""Nothing may be lost or doubled silently: damaged and foldered months, odd CSV files, repeated keys."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from urbanflow.functions.text import mentions
from urbanflow.operators.joins import attach_borough, attach_zone_names, one_row_per_key
from urbanflow.operators.series import densify
from urbanflow.plans.analysis import demand_backtest, demand_forecast, demand_model, feature_correlation
from urbanflow.plans.backfill import backfill
from urbanflow.plans.master import build_master
from urbanflow.sources import catalog
from urbanflow.sources.readers import malformed_fields, read_csv, read_facts, read_months

COLUMNS = ("trip_distance", "fare_amount", "total_amount", "tip_amount")


def trips(year, month, n):
    start = [dt.datetime(year, month, 2) + dt.timedelta(minutes=i % 600) for i in range(n)]
    data = {
        "tpep_pickup_datetime": pa.array(start, pa.timestamp("us")),
        "tpep_dropoff_datetime": pa.array([t + dt.timedelta(minutes=9) for t in start], pa.timestamp("us")),
        "PULocationID": pa.array([i % 20 for i in range(n)], pa.int32()),
    }
    return pa.table(data | {c: pa.array([1.0 + i % 7 for i in range(n)], pa.float64()) for c in COLUMNS})


@pytest.fixture
def folders(tmp_path):
    for month, n in ((1, 30), (2, 50)):
        for part in range(2):
            for name in (f"yellow_tripdata_2024-{month:02d}.parquet", f"hive of all/year=2024/month={month}"):
                (tmp_path / name).mkdir(parents=True, exist_ok=True)
                pq.write_table(trips(2024, month, n), tmp_path / name / f"part-{part}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("template", ["yellow_tripdata_{year:04d}-{month:02d}.parquet", "hive of all/year={year}/month={month}"])
def test_months_in_folders(spark, folders, tmp_path, template):
    months = [(2024, 1), (2024, 2)]
    df, skipped = read_months(spark, folders, months, template=template)
    assert skipped == {} and {r["ym"]: r["count"] for r in df.groupBy("ym").count().collect()} == {"2024-01": 60, "2024-02": 100}
    both, single = str(tmp_path / "both"), str(tmp_path / "single")
    assert backfill(spark, folders, months, both, template=template) == {}
    for m in months:
        backfill(spark, folders, [m], single, template=template)
    rows = [sorted(map(str, read_facts(spark, p).collect())) for p in (both, single)]
    assert rows[0] == rows[1] and read_facts(spark, both).agg(F.sum("trips")).first()[0] == 160


def test_damaged_month(spark, tmp_path):
    pq.write_table(trips(2024, 1, 1000), tmp_path / "yellow_tripdata_2024-01.parquet")
    path = tmp_path / "yellow_tripdata_2024-02.parquet"
    pq.write_table(trips(2024, 2, 20_000), path, row_group_size=2_000, compression="none")
    raw = bytearray(path.read_bytes())
    middle = len(raw) // 2
    raw[middle : middle + 4000] = b"\xff" * 4000
    path.write_bytes(raw)
    months, out = [(2024, 1), (2024, 2)], str(tmp_path / "out")
    with pytest.raises(Exception, match="(?s).+"):
        backfill(spark, str(tmp_path), months, out)
    lost = backfill(spark, str(tmp_path), months, out, ignore_corrupt=True)
    assert set(lost) == {"2024-02"} and "of 20000 rows" in lost["2024-02"]


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'borough,unique_key,created_date,complaint_type,descriptor,latitude,longitude\n'
        'BRONX,1,2024-01-01T00:05:00.000,Noise,"He said ""loud, very"" twice",40.1,-73.9\n'
        'QUEENS,2,oops,"two\nlines",x,1,y\n'
    )
    rows = {r.unique_key: r for r in read_csv(spark, str(tmp_path / "*.csv"), multiline=True).collect()}
    assert rows[1].descriptor == 'He said "loud, very" twice' and rows[1].borough == "BRONX" and rows[1].latitude == 40.1
    assert rows[2].complaint_type == "two\nlines" and rows[2].created_date is None and rows[2].longitude is None
    lost = malformed_fields(spark, str(tmp_path / "*.csv"), multiline=True).first().asDict()
    assert {k for k, n in lost.items() if n} == {"created_date", "longitude"}


def test_a_second_registration_replaces_the_first(spark, tmp_path):
    for name, n in (("a", 3), ("it's b", 5)):
        spark.range(n).write.parquet(str(tmp_path / name))
        assert catalog.register_external(spark, "lossless_t", str(tmp_path / name)).count() == n
    assert spark.read.parquet(str(tmp_path / "a")).count() == 3
    spark.sql("DROP TABLE lossless_t")


def test_repeated_keys_fail_and_null_keys_do_not(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c")], "k int, v string")
    assert [tuple(r) for r in one_row_per_key(rows, ["k"]).collect()] == [(1, "a")]
    with pytest.raises(Exception, match="repeated key"):
        one_row_per_key(rows.union(rows), ["k"]).collect()
    lookup = spark.createDataFrame([("1", "x", "z", "s"), ("1", "y", "z", "s")], "LocationID string, Borough string, Zone string, service_zone string")
    facts = spark.createDataFrame([(1, 7)], "PULocationID int, trips int")
    for attach in (attach_borough, attach_zone_names):
        with pytest.raises(Exception, match="repeated key"):
            attach(facts, lookup).collect()
        assert attach(facts, lookup.limit(1)).count() == 1


def test_master_keeps_every_trip_row_once(spark):
    hour = dt.datetime(2024, 1, 1, 5)
    taxi = spark.createDataFrame([(hour, "bronx", 4)], "hour_ts timestamp_ntz, borough string, trips long")
    c311 = spark.createDataFrame(
        [(hour, " Bronx", 2, 1), (hour, "BRONX", 3, 0)], "hour_ts timestamp_ntz, borough string, complaints_total long, complaints_noise long"
    )
    weather = spark.createDataFrame([(hour, 1.5), (None, 2.0), (None, 3.0)], "hour_ts timestamp_ntz, temp_avg double")
    rows = build_master(taxi, c311, weather).collect()
    assert [(r.trips, r.complaints_311, r.complaints_noise, r.temp_avg) for r in rows] == [(4, 5, 1, 1.5)]


def test_small_edges(spark):
    assert spark.range(1).select(mentions(F.lit("x"), [])).first()[0] is False
    day = dt.date(2024, 1, 3)
    df = spark.createDataFrame([(day, 1), (day, 2), (dt.date(2024, 1, 5), 3)], "day date, n int")
    assert sorted(r.day.day for r in densify(df, "day").collect()) == [3, 3, 4, 5]


def test_demand_plans_and_a_null_in_the_last_week(spark):
    rows, state = [], 3.0
    for i in range(120):
        state = 0.5 * state + (i * 37 % 11) / 11
        drivers = [float(i * 13 % 7), float(i * 5 % 9)]
        rows.append(("b", dt.date(2024, 1, 1) + dt.timedelta(days=i), None if i == 116 else 50 + 5 * state + 3 * (i % 7) + drivers[0], *drivers))
    series = spark.createDataFrame(rows, "borough string, day date, trips double, x double, z double")
    ahead = demand_forecast(series, drivers=["x", "z"]).orderBy("step").collect()
    assert [r.step for r in ahead] == list(range(1, 15)) and all(r.forecast is not None and 30 < r.forecast < 100 for r in ahead)
    known = series.na.drop()
    fits, predicted = demand_model(known, drivers=["x", "z"])
    fit = fits.first()
    assert len(fit.coef) == 3 + 2 + 3 and fit.r2 > 0.8 and predicted.count() == known.count()
    metrics, forecasts = demand_backtest(known, drivers=["x", "z"])
    assert metrics.first().mape < 10 and forecasts.where("predicted is null").count() == 0
    pairs = {(r.var_x, r.var_y): r.corr for r in feature_correlation(known, ["trips", "x", "absent"]).collect()}
    assert len(pairs) == 4 and pairs["x", "x"] == pytest.approx(1)
