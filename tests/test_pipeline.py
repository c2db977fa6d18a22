"""From raw files to the published view and a daily series, as a user would run it."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from urbanflow.functions.times import month_range
from urbanflow.operators.flatten import flatten_object
from urbanflow.operators.series import decompose_additive, resample_daily
from urbanflow.plans.analysis import prepare_series
from urbanflow.plans.backfill import backfill
from urbanflow.plans.facts import borough_facts, complaint_facts
from urbanflow.plans.master import borough_view, build_master, finalise, flattened_borough_view
from urbanflow.plans.weather import decode_weather, weather_for_master
from urbanflow.sources.readers import month_path, read_csv, read_facts, read_lookup, read_weather, with_path_partitions
from urbanflow.sources.writers import write_fact


def test_raw_files_to_daily_series(spark, tmp_path, plan):
    raw = tmp_path / "raw"
    raw.mkdir()
    first, hours = dt.datetime(2023, 12, 20), 24 * 24
    for year, month in month_range((2023, 12), (2024, 1)):
        stamps = [first + dt.timedelta(hours=h) for h in range(hours)]
        stamps = [s for s in stamps if (s.year, s.month) == (year, month)] * 2
        n = len(stamps)
        pq.write_table(
            pa.table(
                {
                    "tpep_pickup_datetime": pa.array(stamps, pa.timestamp("us")),
                    "tpep_dropoff_datetime": pa.array([s + dt.timedelta(minutes=12) for s in stamps], pa.timestamp("us")),
                    "PULocationID": pa.array([1 + i % 3 for i in range(n)], pa.int64()),
                    **{c: [10.5] * n for c in ("trip_distance", "fare_amount", "total_amount", "tip_amount")},
                }
            ),
            month_path(str(raw), year, month),
        )
    (raw / "zones.csv").write_text(
        "LocationID,Borough,Zone,service_zone\n1,Manhattan,A,Y\n2,manhattan ,B,Y\n3,Unknown,C,N/A\n"
    )
    (raw / "c.csv").write_text(
        "unique_key,created_date,complaint_type,descriptor,borough,latitude,longitude\n"
        "1,2023-12-21T00:05:00.000,Noise - Street/Sidewalk,x,MANHATTAN,1,1\n"
    )
    epoch = [int((first + dt.timedelta(hours=h)).replace(tzinfo=dt.timezone.utc).timestamp()) * 10**9 for h in range(hours)]
    weather_file = {"time": pa.array(epoch, pa.int64()).cast(pa.timestamp("ns")), "coco": [8.0] * hours, "wpgt": [10.0] * hours}
    pq.write_table(pa.table(weather_file), str(raw / "weather.parquet"))

    zones, master_path = str(tmp_path / "zones"), str(tmp_path / "master")
    assert backfill(spark, str(raw), month_range((2023, 12), (2024, 1)), zones) == {}
    taxi = borough_facts(read_facts(spark, zones), read_lookup(spark, str(raw / "zones.csv")))
    c311 = complaint_facts(read_csv(spark, str(raw / "c.csv")))
    weather = weather_for_master(decode_weather(read_weather(spark, str(raw / "weather.parquet"))))
    write_fact(build_master(taxi, c311, weather), master_path)

    master = read_facts(spark, master_path)
    assert master.agg(F.sum("trips")).first()[0] == hours * 2
    assert "PartitionFilters: [isnotnull(year" in plan(master.filter("year = 2023 AND month = 12"))
    december = master.filter("year = 2023 AND month = 12 AND borough = 'MANHATTAN' AND complaints_311 = 1")
    assert december.count() == 1 and december.first()["rain_text"] == "Rain"

    # The same table as a column of objects, flattened back into a typed view.
    staged = with_path_partitions(spark.read.option("recursiveFileLookup", "true").parquet(master_path))
    inner = [c for c in staged.columns if c not in ("year", "month", "source_file")]
    objects = staged.select("year", "month", "source_file", F.to_json(F.struct(*inner)).alias("value"))
    view = borough_view(finalise(flattened_borough_view(flatten_object(objects, "value"))))
    assert {r["borough"] for r in view.select("borough").distinct().collect()} == {"MANHATTAN"}

    series = resample_daily(prepare_series(view, ["MANHATTAN"]), "datetime", {"trips": "sum", "temp_avg": "mean"})
    days = series.orderBy("day").collect()
    assert len(days) == 24 and days[0]["day"] == first.date() and sum(r["trips"] for r in days) == hours * 2 * 2 / 3
    parts = decompose_additive(series, "trips", "day").filter("trend IS NOT NULL")
    assert parts.count() == 24 - 6
    assert parts.filter("abs(observed - trend - seasonal - resid) > 1e-9").count() == 0
