"""Facts, joins, decoding and the master table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from ..functions.times import epoch_nanos_to_time
from ..functions.weather import code_in, code_text, is_extreme
from ..operators.joins import attach_borough
from ..operators.predicates import in_month, within_bounds
from ..operators.project import keep_present, rename_first
from ..operators.quality import top_n
from ..operators.rollup import classify_counts, hourly_rollup
from ..plans.analysis import clean_published
from ..plans.facts import borough_facts, complaint_facts, named_zone_facts, with_duration, zone_facts
from ..plans.master import borough_view, build_master, colocate, finalise, normalise_complaints, zone_view
from ..plans.weather import decode_weather, weather_for_master
from ..schemas import COMPLAINT_TOTAL_NAMES, NAMED_TRIP_MEASURES, NO_RAIN, NO_SNOW, RAIN_TEXT, SNOW_TEXT, TRIP_MEASURES, Measure
from ..session import shared_folder
from .inputs import (
    COMPLAINTS_SQL,
    DAY_BOUNDS,
    EVENT_TRIPS_SQL,
    EXACT_MEASURES,
    HOURLY_WEATHER_SQL,
    LOOKUP_SQL,
    MONEY,
    ORDER_MEASURES,
    ORDER_TRIPS_SQL,
    WEATHER_SQL,
    ZONE_HOURS_SQL,
    event_complaints,
    event_trips,
    mean_sql,
    order_trips,
    table,
    weather_rows,
    zone_lookup,
)
from .registry import query, rounded

MEANS = tuple(m.mean_as for m in TRIP_MEASURES)
PARTS_SQL = """CAST(year(hour_ts) AS INTEGER) AS year, CAST(month(hour_ts) AS INTEGER) AS month,
  CAST(day(hour_ts) AS INTEGER) AS day, CAST(hour(hour_ts) AS INTEGER) AS hour"""


# --- trips ------------------------------------------------------------------


@query(
    "q01_daily_zone_rollup",
    f"""
SELECT date_trunc('day', o_orderdate) AS day, c_nationkey AS zone, COUNT(*) AS trips,
       {mean_sql('o_totalprice')} AS avg_total_amount
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def daily_zone_rollup(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    customer = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("zone"))
    rows = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    return hourly_rollup(rows, "o_orderdate", ["zone"], [Measure("o_totalprice", "avg_total_amount", digits=2)], "day", "day")


@query(
    "q02_one_month",
    """
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-12-01' AND o_orderdate < TIMESTAMP '1998-01-01'""",
)
def one_month(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").filter(in_month("o_orderdate", 1997, 12))
    return orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


@query(
    "q03_sane_trips",
    f"""
WITH {ORDER_TRIPS_SQL}
SELECT pickup, dropoff, zone, secs / CAST(60 AS DOUBLE) AS duration_min, distance, fare, total FROM sane""",
)
def sane_trips(spark: SparkSession, sf: str) -> DataFrame:
    rows = within_bounds(with_duration(order_trips(spark, sf)), DAY_BOUNDS, not_null=["PULocationID"])
    return rows.select(
        F.col("tpep_pickup_datetime").alias("pickup"),
        F.col("tpep_dropoff_datetime").alias("dropoff"),
        F.col("PULocationID").alias("zone"),
        (F.col("trip_duration_s") / F.lit(60.0)).alias("duration_min"),
        F.col("trip_distance").alias("distance"),
        F.col("fare_amount").alias("fare"),
        F.col("total_amount").alias("total"),
    )


@query(
    "q03_zone_day_facts",
    f"""
WITH {ORDER_TRIPS_SQL},
facts AS (
  SELECT date_trunc('day', pickup) AS hour_ts, zone AS PULocationID, COUNT(*) AS trips,
         CAST(SUM(secs) AS DOUBLE) / (COUNT(secs) * CAST(60 AS DOUBLE)) AS avg_trip_duration_min,
         {mean_sql('fare')} AS avg_fare_amount,
         {mean_sql('distance')} AS avg_trip_distance,
         {mean_sql('total')} AS avg_total_amount,
         {mean_sql('tip', 4)} AS avg_tip_amount
  FROM sane GROUP BY 1, 2)
SELECT *, {PARTS_SQL} FROM facts""",
)
def zone_day_facts(spark: SparkSession, sf: str) -> DataFrame:
    return zone_facts(order_trips(spark, sf), bounds=DAY_BOUNDS, measures=ORDER_MEASURES, grain="day")


def _zone_hours(spark: SparkSession, sf: str) -> DataFrame:
    return zone_facts(event_trips(spark, sf), measures=EXACT_MEASURES)


@query("q04_zone_hour_facts", f"WITH {ZONE_HOURS_SQL} SELECT * EXCLUDE (zone), zone AS PULocationID, {PARTS_SQL} FROM zone_hours "
    "WHERE hour_ts >= TIMESTAMP '2024-01-01' AND hour_ts < TIMESTAMP '2024-02-01'")
def zone_hour_facts(spark: SparkSession, sf: str) -> DataFrame:
    return zone_facts(event_trips(spark, sf), month=(2024, 1), measures=EXACT_MEASURES)


@query(
    "q04_plain_means",
    f"""
WITH {EVENT_TRIPS_SQL},
plain AS (
  SELECT date_trunc('hour', ts) AS hour_ts, zone AS PULocationID, COUNT(*) AS trips,
         ROUND(CAST(SUM(secs) AS DOUBLE) / (COUNT(secs) * 60), 6) AS avg_trip_duration_min,
         ROUND(AVG(fare), 6) AS avg_fare_amount, ROUND(AVG(distance), 6) AS avg_trip_distance,
         ROUND(AVG(total), 6) AS avg_total_amount, ROUND(AVG(tip), 6) AS avg_tip_amount
  FROM trips
  WHERE secs > 0 AND secs <= 14400 AND distance BETWEEN 0 AND 200 AND fare BETWEEN 0 AND 1000 AND total BETWEEN 0 AND 2000
  GROUP BY 1, 2)
SELECT *, {PARTS_SQL} FROM plain""",
)
def plain_means(spark: SparkSession, sf: str) -> DataFrame:
    """The facts with the measures as they are shipped, sums of doubles."""
    return rounded(zone_facts(event_trips(spark, sf)), 6, *MEANS)


@query(
    "q05_attach_borough",
    f"""
WITH {ZONE_HOURS_SQL}, {LOOKUP_SQL}
SELECT hour_ts, z.zone AS PULocationID, trips, upper(trim(borough)) AS borough
FROM zone_hours z JOIN lookup ON z.zone = id""",
)
def with_borough(spark: SparkSession, sf: str) -> DataFrame:
    joined = attach_borough(_zone_hours(spark, sf), zone_lookup(spark, sf))
    return joined.select("hour_ts", "PULocationID", "trips", "borough")


def _borough_hours_sql(tip_rows: str = "trips") -> str:
    means = ",\n".join(
        f"         SUM({m} * trips) / SUM({tip_rows if m == 'avg_tip_amount' else 'trips'}) AS {m}" for m in MEANS
    )
    return f"""{ZONE_HOURS_SQL}, {LOOKUP_SQL},
borough_hours AS (
  SELECT hour_ts, upper(trim(borough)) AS borough, CAST(SUM(trips) AS BIGINT) AS trips,
{means}
  FROM zone_hours z JOIN lookup ON z.zone = id GROUP BY 1, 2)"""


BOROUGH_HOURS_SQL = _borough_hours_sql()
ROUNDED_MEANS = ", ".join(f"ROUND({m}, 6) AS {m}" for m in MEANS)


@query(
    "q06_borough_hour_facts",
    f"WITH {BOROUGH_HOURS_SQL} SELECT hour_ts, {PARTS_SQL}, borough, trips, {ROUNDED_MEANS} FROM borough_hours",
)
def borough_hour_facts(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(borough_facts(_zone_hours(spark, sf), zone_lookup(spark, sf)), 6, *MEANS)


@query(
    "q06_borough_hour_facts_strict",
    f"WITH {_borough_hours_sql('CASE WHEN avg_tip_amount IS NOT NULL THEN trips END')} "
    f"SELECT hour_ts, {PARTS_SQL}, borough, trips, {ROUNDED_MEANS} FROM borough_hours",
)
def borough_hour_facts_strict(spark: SparkSession, sf: str) -> DataFrame:
    facts = borough_facts(_zone_hours(spark, sf), zone_lookup(spark, sf), strict=True)
    return rounded(facts, 6, *MEANS)


NAMED_SQL = f"""{EVENT_TRIPS_SQL}, {LOOKUP_SQL},
named AS (
  SELECT hour_ts, f.zone AS locationid, borough, lookup.zone AS zone, service_zone, trips,
         avg_fare_amount, avg_tip_amount, avg_total_amount, avg_trip_distance
  FROM (SELECT date_trunc('hour', ts) AS hour_ts, zone, COUNT(*) AS trips,
               {mean_sql('fare')} AS avg_fare_amount,
               {mean_sql('tip')} AS avg_tip_amount,
               {mean_sql('total')} AS avg_total_amount,
               {mean_sql('distance')} AS avg_trip_distance
        FROM trips WHERE ts IS NOT NULL AND zone IS NOT NULL GROUP BY 1, 2) f
  LEFT JOIN lookup ON f.zone = id)"""


@query("q07_named_zone_facts", f"WITH {NAMED_SQL} SELECT * FROM named")
def named_facts(spark: SparkSession, sf: str) -> DataFrame:
    exact = [Measure(m.source, m.mean_as, digits=2) for m in NAMED_TRIP_MEASURES]
    return named_zone_facts(event_trips(spark, sf), zone_lookup(spark, sf), measures=exact)


@query(
    "q07_zone_view",
    f"""
WITH {NAMED_SQL}
SELECT hour_ts, locationid, borough, zone, service_zone, CAST(trips AS INTEGER) AS trips,
       avg_fare_amount, avg_tip_amount, avg_total_amount, avg_trip_distance FROM named""",
)
def published_zones(spark: SparkSession, sf: str) -> DataFrame:
    return zone_view(named_facts(spark, sf))


# --- complaints -------------------------------------------------------------


@query("q08_complaint_facts", f"WITH {COMPLAINTS_SQL} SELECT *, {PARTS_SQL} FROM complaint_hours")
def complaint_hour_facts(spark: SparkSession, sf: str) -> DataFrame:
    return complaint_facts(event_complaints(spark, sf))


PRIORITY_CLASSES = {"urgent": ("urgent",), "ranked": ("high", "medium", "low"), "unset": ("not specified", "low")}


@query(
    "q08_priority_classes",
    """
SELECT date_trunc('day', o_orderdate) AS day, o_orderstatus, COUNT(*) AS orders_total,
       COUNT(*) FILTER (regexp_matches(o_orderpriority, '(?i)urgent')) AS orders_urgent,
       COUNT(*) FILTER (regexp_matches(o_orderpriority, '(?i)high|medium|low')) AS orders_ranked,
       COUNT(*) FILTER (regexp_matches(o_orderpriority, '(?i)not specified|low')) AS orders_unset
FROM orders GROUP BY 1, 2""",
)
def priority_classes(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_trunc("day", "o_orderdate").cast("timestamp_ntz").alias("day")
    orders = table(spark, sf, "orders")
    return classify_counts(
        orders, [day, "o_orderstatus"], "o_orderpriority", PRIORITY_CLASSES, "orders_total", "orders"
    )


@query(
    "q09_complaint_fallback",
    f"""
WITH {COMPLAINTS_SQL}
SELECT date_trunc('hour', created_date) AS hour_ts, upper(trim(borough)) AS borough, COUNT(*) AS complaints_311,
       COUNT(*) FILTER (contains(upper(complaint_type), 'NOISE')) AS complaints_noise,
       COUNT(*) FILTER (regexp_matches(upper(complaint_type),
         'SANITATION|UNSANITARY|GARBAGE|RODENT|PEST')) AS complaints_sanitation,
       COUNT(*) FILTER (regexp_matches(upper(complaint_type),
         'TRANSPORT|TRAFFIC|PARKING|STREET|VEHICLE')) AS complaints_transportation
FROM complaints GROUP BY 1, 2""",
)
def complaint_fallback(spark: SparkSession, sf: str) -> DataFrame:
    return normalise_complaints(event_complaints(spark, sf))


@query(
    "q14_drifting_names",
    f"""
WITH {COMPLAINTS_SQL}
SELECT hour_ts, borough, complaints_total AS complaints_311, complaints_noise FROM complaint_hours""",
)
def drifting_names(spark: SparkSession, sf: str) -> DataFrame:
    delivered = complaint_facts(event_complaints(spark, sf)).withColumnRenamed("complaints_total", "total_complaints")
    renamed = rename_first(delivered, COMPLAINT_TOTAL_NAMES, "complaints_311")
    return keep_present(renamed, ["hour_ts", "borough", "complaints_311", "complaints_noise", "complaints_other"])


# --- weather ----------------------------------------------------------------

CODES_SQL = """
SELECT event_id, CAST(CASE WHEN code BETWEEN 7 AND 13 THEN code ELSE 0 END AS INTEGER) AS rain_code,
       CASE code WHEN 7 THEN 'Light rain' WHEN 8 THEN 'Rain' WHEN 9 THEN 'Heavy rain' WHEN 10 THEN 'Freezing rain'
                 WHEN 11 THEN 'Heavy freezing rain' WHEN 12 THEN 'Sleet' WHEN 13 THEN 'Heavy sleet'
                 ELSE 'No rain' END AS rain_text,
       CAST(CASE WHEN code BETWEEN 15 AND 18 THEN code ELSE 0 END AS INTEGER) AS snow_code,
       CASE code WHEN 15 THEN 'Light snow' WHEN 16 THEN 'Snow' WHEN 17 THEN 'Heavy snow' WHEN 18 THEN 'Snowstorm'
                 ELSE 'No snow' END AS snow_text,
       CASE WHEN code IN (9, 11, 13, 17, 18) OR gust > 20 THEN 1 ELSE 0 END AS extreme_weather
FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN event_id % 28 END AS code,
             CASE WHEN event_type <> 'view' THEN value END AS gust FROM events)"""


@query("q10_weather_codes", CODES_SQL)
def weather_codes(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("event_id") % 28).alias("code"),
        F.when(F.col("event_type") != "view", F.col("value")).alias("gust"),
    )
    return rows.select(
        "event_id",
        code_in("code", RAIN_TEXT).alias("rain_code"),
        code_text("code", RAIN_TEXT, NO_RAIN).alias("rain_text"),
        code_in("code", SNOW_TEXT).alias("snow_code"),
        code_text("code", SNOW_TEXT, NO_SNOW).alias("snow_text"),
        is_extreme("code", "gust").alias("extreme_weather"),
    )


@query(
    "q11_epoch_nanos",
    "SELECT event_id, epoch_us(ts) * 1000 + 999 AS time_ns, ts, date_trunc('hour', ts) AS hour_ts FROM events",
)
def epoch_nanos(spark: SparkSession, sf: str) -> DataFrame:
    nanos = F.unix_micros(F.col("ts").cast("timestamp")) * 1000 + 999
    rows = table(spark, sf, "events").select("event_id", nanos.alias("time_ns"))
    ts = epoch_nanos_to_time("time_ns")
    return rows.withColumn("ts", ts).withColumn("hour_ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))


@query("q12_decoded_weather", f"WITH {WEATHER_SQL} SELECT *, {PARTS_SQL} FROM weather")
def decoded_weather(spark: SparkSession, sf: str) -> DataFrame:
    return decode_weather(weather_rows(spark, sf))


# --- master -----------------------------------------------------------------

MASTER_SQL = f"""{BOROUGH_HOURS_SQL}, {COMPLAINTS_SQL}, {HOURLY_WEATHER_SQL},
master AS (
  SELECT b.hour_ts, {PARTS_SQL.replace('(hour_ts)', '(b.hour_ts)')}, b.borough, b.trips, {ROUNDED_MEANS},
         COALESCE(complaints_total, 0) AS complaints_311, COALESCE(complaints_noise, 0) AS complaints_noise,
         COALESCE(complaints_sanitation, 0) AS complaints_sanitation,
         COALESCE(complaints_transportation, 0) AS complaints_transportation,
         temp AS temp_avg, dwpt AS dewpoint_avg, rhum AS humidity_avg, wspd AS wind_avg, wpgt AS wind_gust_avg,
         pres AS pressure_avg, prcp AS precip_total, w.snow AS snow_total,
         CASE WHEN w.hour_ts IS NOT NULL THEN CASE WHEN rain_code > 0 THEN 1 ELSE 0 END END AS rain,
         rain_code, rain_text,
         CASE WHEN w.hour_ts IS NOT NULL THEN CASE WHEN snow_code > 0 THEN 1 ELSE 0 END END AS snow,
         snow_code, snow_text, extreme_weather
  FROM borough_hours b
  LEFT JOIN complaint_hours c ON b.hour_ts = c.hour_ts AND b.borough = c.borough
  LEFT JOIN weather w ON b.hour_ts = w.hour_ts)"""


def master_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    taxi = borough_facts(_zone_hours(spark, sf), zone_lookup(spark, sf))
    c311 = complaint_facts(event_complaints(spark, sf))
    return taxi, c311, weather_for_master(decode_weather(weather_rows(spark, sf, hourly=True)))


def master_table(spark: SparkSession, sf: str) -> DataFrame:
    return build_master(*master_inputs(spark, sf))


@query("q13_master", f"WITH {MASTER_SQL} SELECT * FROM master")
def master(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(master_table(spark, sf), 6, *MEANS)


@query("q13_colocated_master", f"WITH {MASTER_SQL} SELECT * FROM master")
def colocated_master(spark: SparkSession, sf: str) -> DataFrame:
    """The master joined from tables bucketed by hour."""
    run = uuid.uuid4().hex
    tables = colocate(*master_inputs(spark, sf), f"facts_{run}", 8, f"{shared_folder(spark)}/facts-{run}")
    return rounded(build_master(*tables), 6, *MEANS)


@query(
    "q29_first_master_rows",
    f"WITH {MASTER_SQL} SELECT hour_ts, borough, trips, complaints_311 FROM master ORDER BY hour_ts, borough LIMIT 20",
)
def first_master_rows(spark: SparkSession, sf: str) -> DataFrame:
    return top_n(master_table(spark, sf), 20, "hour_ts", "borough").select(
        "hour_ts", "borough", "trips", "complaints_311"
    )


# --- published tables -------------------------------------------------------

QUOTED_SQL = """quoted AS (
  SELECT CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'unknown'
              ELSE ' "' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '"' END AS hour_ts,
         ' "' || lower(o_orderstatus) || '" ' AS borough,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS trips,
         CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
              END AS avg_fare_amount,
         '"' || o_orderpriority || '"' AS rain_text
  FROM orders)"""


@query(
    "q17_typed_view",
    f"""
WITH {QUOTED_SQL}
SELECT * FROM (
  SELECT TRY_CAST(trim(replace(hour_ts, '"', '')) AS TIMESTAMP) AS hour_ts,
         upper(trim(replace(borough, '"', ''))) AS borough,
         TRY_CAST(trips AS BIGINT) AS trips, TRY_CAST(avg_fare_amount AS DOUBLE) AS avg_fare_amount,
         trim(replace(rain_text, '"', '')) AS rain_text
  FROM quoted) WHERE hour_ts IS NOT NULL""",
)
def typed_view(spark: SparkSession, sf: str) -> DataFrame:
    quote, prio = F.lit('"'), F.col("o_orderpriority")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    bad_time = (prio == "5-LOW") & (F.col("o_orderstatus") == "P")
    quoted = table(spark, sf, "orders").select(
        F.when(bad_time, "unknown").otherwise(F.concat(F.lit(' "'), stamp, quote)).alias("hour_ts"),
        F.concat(F.lit(' "'), F.lower("o_orderstatus"), F.lit('" ')).alias("borough"),
        F.when(prio == "4-NOT SPECIFIED", "n/a").otherwise(F.col("o_custkey").cast("string")).alias("trips"),
        F.when(prio == "1-URGENT", "").otherwise(F.col("o_totalprice").cast(MONEY).cast("string")).alias("avg_fare_amount"),
        F.concat(quote, prio, quote).alias("rain_text"),
    )
    return borough_view(clean_published(quoted)).select("hour_ts", "borough", "trips", "avg_fare_amount", "rain_text")


@query("q19_known_boroughs", f"WITH {NAMED_SQL} SELECT * FROM named WHERE borough NOT IN (' asia', ' europe')")
def known_boroughs(spark: SparkSession, sf: str) -> DataFrame:
    return finalise(named_facts(spark, sf), unknown=(" asia", " europe"))


