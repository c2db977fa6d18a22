import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from urbanflow.plans.analysis import clean_published, prepare_series
from urbanflow.plans.facts import borough_facts, complaint_facts, named_zone_facts, zone_facts
from urbanflow.plans.master import borough_view, build_master, colocate, finalise, flattened_borough_view, normalise_complaints
from urbanflow.plans.weather import decode_weather, weather_for_master
from urbanflow.operators.flatten import flatten_object
from urbanflow.operators.predicates import in_month
from urbanflow.schemas import BOROUGH_VIEW, COMPLAINT, MASTER, TRIP, WEATHER

DAY = dt.datetime(2023, 12, 31)
H8 = dt.datetime(2023, 12, 31, 8)


def at(hour, minute=0, day=DAY):
    return day + dt.timedelta(hours=hour, minutes=minute)


@pytest.fixture
def trips(spark):
    def trip(pickup, minutes, zone, miles=1.0, fare=10.0, total=12.0, tip=1.0):
        return (pickup, pickup and pickup + dt.timedelta(minutes=minutes), zone, miles, fare, total, tip)

    data = [
        trip(at(8), 10, 1),
        trip(at(8, 59), 20, 1, tip=None),
        trip(at(8, 30), 30, 2, fare=40.0),
        trip(at(8, 30), 30, 9),
        trip(at(8, 30), 30, None),
        trip(at(8, 30), 0, 1),
        trip(at(8, 30), 241, 1),
        trip(at(8, 30), 240, 1, tip=None),
        trip(at(8, 30), 10, 1, fare=None),
        trip(at(24), 10, 1),
        trip(dt.datetime(2023, 11, 30, 23, 59), 10, 1),
        trip(None, 10, 1),
    ]
    return spark.createDataFrame(data, TRIP)


@pytest.fixture
def lookup(spark):
    data = [("1", "Bronx", "A", "S"), ("2", " bronx ", "B", "S"), ("3", "Unknown", "C", "S")]
    return spark.createDataFrame(data, "LocationID string, Borough string, Zone string, service_zone string")


def test_zone_facts(trips):
    got = {r["PULocationID"]: r for r in zone_facts(trips, (2023, 12)).collect()}
    assert set(got) == {1, 2, 9}
    one = got[1]
    assert (one["hour_ts"], one["year"], one["month"], one["day"], one["hour"]) == (H8, 2023, 12, 31, 8)
    assert one["trips"] == 3 and one["avg_trip_duration_min"] == 90.0 and one["avg_tip_amount"] == 1.0
    everything = zone_facts(trips, bounds=None)
    assert everything.agg(F.sum("trips")).first()[0] == trips.filter("PULocationID IS NOT NULL").count()


def test_named_zone_facts(trips, lookup):
    facts = named_zone_facts(trips, lookup, in_month("tpep_pickup_datetime", 2023, 12))
    got = {r["locationid"]: r for r in facts.collect()}
    assert got[1]["trips"] == 6 and got[1]["zone"] == "A" and got[9]["zone"] is None
    assert "avg_trip_duration_min" not in facts.columns


def test_borough_facts_keep_trips(trips, lookup):
    zones = zone_facts(trips, (2023, 12))
    (row,) = borough_facts(zones, lookup).collect()
    assert row["borough"] == "BRONX" and row["trips"] == 4
    assert row["avg_fare_amount"] == (10 * 3 + 40) / 4
    matched = zones.filter("PULocationID IN (1, 2)").agg(F.sum("trips")).first()[0]
    assert row["trips"] == matched


@pytest.fixture
def complaints(spark):
    data = [
        (1, at(8, 5), "Noise - Street/Sidewalk", None, " bronx", None, None),
        (2, at(8, 6), None, None, "BRONX", None, None),
        (3, at(8, 7), "Rodent", None, "", None, None),
        (4, at(8, 7), "Rodent", None, None, None, None),
        (5, None, "Rodent", None, "Bronx", None, None),
        (6, at(9, 7), "UNSANITARY CONDITION", None, "Queens", None, None),
    ]
    return spark.createDataFrame(data, COMPLAINT)


def test_complaint_facts(complaints):
    got = {r["borough"]: r for r in complaint_facts(complaints).collect()}
    assert set(got) == {"BRONX", "QUEENS"}
    b = got["BRONX"]
    assert (b["complaints_total"], b["complaints_noise"], b["complaints_sanitation"], b["complaints_transportation"]) == (2, 1, 0, 1)
    cols = ["complaints_total", "complaints_noise", "complaints_sanitation", "complaints_transportation"]
    a = sorted(map(tuple, complaint_facts(complaints).select("borough", *cols).collect()))
    assert a == sorted(map(tuple, complaint_facts(complaints, by="upper").select("borough", *cols).collect()))


@pytest.fixture
def weather(spark):
    def hour(h, coco, gust):
        nanos = int(at(h, 20).replace(tzinfo=dt.timezone.utc).timestamp()) * 10**9
        return (nanos, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, gust, 9.0, None, coco)

    return spark.createDataFrame([hour(8, 16.0, None), hour(9, None, 20.1)], WEATHER)


def test_decode_weather(weather):
    got = decode_weather(weather).orderBy("hour_ts").collect()
    assert [r["hour_ts"] for r in got] == [H8, at(9)] and got[0]["ts"] == at(8, 20)
    assert (got[0]["snow_code"], got[0]["snow_text"], got[0]["rain_text"]) == (16, "Snow", "No rain")
    assert [r["extreme_weather"] for r in got] == [0, 1]
    shifted = decode_weather(weather, tz="America/New_York").orderBy("hour_ts").first()
    assert shifted["hour_ts"] == at(3)
    named = weather_for_master(decode_weather(weather)).orderBy("hour_ts").first()
    assert (named["snow_total"], named["snow"], named["rain"], named["wind_gust_avg"]) == (5.0, 1, 0, None)


def test_master(trips, lookup, complaints, weather):
    taxi = borough_facts(zone_facts(trips), lookup)
    decoded = weather_for_master(decode_weather(weather))
    master = build_master(taxi, complaint_facts(complaints), decoded)
    assert master.columns == MASTER.fieldNames()
    assert master.count() == taxi.count()
    got = {r["hour_ts"]: r for r in master.collect()}
    assert got[H8]["complaints_311"] == 2 and got[H8]["snow"] == 1
    other = got[dt.datetime(2024, 1, 1)]
    assert other["complaints_311"] == 0 and other["temp_avg"] is None

    raw = build_master(taxi, complaints.withColumnRenamed("created_date", "created_ts"), decoded)
    assert raw.filter(F.col("hour_ts") == H8).first()["complaints_311"] == 2

    lean = build_master(taxi, complaint_facts(complaints).drop("complaints_noise"), decoded.drop("rain_text"))
    assert "complaints_noise" not in lean.columns and "rain_text" not in lean.columns

    twice = decoded.unionByName(decoded)
    with pytest.raises(PySparkException, match="repeated key"):
        build_master(taxi, complaint_facts(complaints), twice).collect()
    kept = build_master(taxi, complaint_facts(complaints), twice, duplicate_weather="keep")
    assert kept.count() == taxi.count() + 1


def test_normalise_complaints_names(spark):
    df = spark.createDataFrame([("x", 1)], "borough string, total_complaints bigint")
    assert normalise_complaints(df).first().asDict() == {"borough": "X", "complaints_311": 1}


def test_object_table_to_view(spark):
    value = '{"hour_ts": "2024-01-01 05:00:00", "Borough": "Bronx", "trips": "7", "temp_avg": "bad"}'
    data = [(2024, 1, value, "f1"), (2024, 1, '{"Borough": "N/A", "trips": "1"}', "f1"), (2024, 1, "{}", "f1")]
    table = spark.createDataFrame(data, "year int, month int, value string, source_file string")
    final = finalise(flattened_borough_view(flatten_object(table, "value")))
    view = borough_view(final)
    assert view.columns == BOROUGH_VIEW.fieldNames()
    (row,) = view.collect()
    assert (row["hour_ts"], row["trips"], row["temp_avg"], row["source_file"]) == (dt.datetime(2024, 1, 1, 5), 7, None, "f1")


def test_prepare_series(spark):
    data = [
        ('"2024-01-01 05:00:00"', ' "bronx" ', "12", 2024, 1, 1, 5, '"Snow"'),
        ("2024-01-01 06:00:00", "Queens", "x", 2024, 1, 1, 6, None),
        ("never", "Bronx", "3", 2024, 1, 1, 7, None),
    ]
    df = spark.createDataFrame(data, "HOUR_TS string, BOROUGH string, TRIPS string, YEAR int, MONTH int, DAY int, HOUR int, SNOW_TEXT string")
    cleaned = clean_published(df)
    assert cleaned.count() == 2 and cleaned.filter("borough = 'QUEENS'").first()["trips"] is None
    (row,) = prepare_series(df, ["BRONX"]).collect()
    assert (row["datetime"], row["trips"], row["snow_text"]) == (dt.datetime(2024, 1, 1, 5), 12.0, "Snow")
    assert prepare_series(df).count() == 2


def test_colocated_master_needs_no_shuffle(spark, tmp_path, plan):
    """Above the broadcast threshold, nothing below the joins of the master is shuffled, and the result is the same."""
    hours = spark.range(200).selectExpr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, int(id)) AS hour_ts", "id")
    boroughs = spark.createDataFrame([("bronx ",), ("QUEENS",), (" Bronx",)], "borough string")
    taxi = hours.crossJoin(boroughs.limit(2)).selectExpr(
        "hour_ts", "year(hour_ts) AS year", "month(hour_ts) AS month", "day(hour_ts) AS day", "hour(hour_ts) AS hour", "borough", "id AS trips"
    )
    c311 = hours.where("id % 3 = 0").crossJoin(boroughs).selectExpr("hour_ts", "borough", "id AS complaints_total", "id % 5 AS complaints_noise")
    weather = hours.where("id % 7 > 0").selectExpr("hour_ts", "id / 2.0D AS temp_avg", "1 AS rain")
    expected = sorted(map(str, build_master(taxi, c311, weather).collect()))
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.requireAllClusterKeysForCoPartition")}
    tables = colocate(taxi, c311, weather, "colocated", 6, str(tmp_path))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        df = build_master(*tables)
        text = plan(df)
        assert text.count("SortMergeJoin") == 2 and "Exchange" not in text and "Broadcast" not in text
        assert "Exchange" in plan(build_master(taxi, c311, weather))
        assert sorted(map(str, df.collect())) == expected
        twice = weather.unionAll(weather.limit(1))
        with pytest.raises(Exception, match="repeated key"):
            build_master(tables[0], tables[1], twice).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        for role in ("taxi", "c311", "weather"):
            spark.sql(f"DROP TABLE colocated_{role}")
