"""The given tables in the roles of trips, complaints, weather and zone lookup.

Each view is built twice, as a DataFrame and as SQL common table expressions,
and always from whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.project import conform
from ..operators.quality import dedup_by_key
from ..operators.series import resample_daily
from ..schemas import TRIP, TRIP_MEASURES, WEATHER, Bound, Measure

MONEY = T.DecimalType(18, 2)

TRIP_EVENTS = ("view", "click", "purchase")
COMPLAINT_EVENTS = ("error", "signup")

COMPLAINT_TEXTS = (
    "Noise - Residential",
    "Noise - Street/Sidewalk",
    "UNSANITARY CONDITION",
    "Rodent",
    "Illegal Parking",
    "Abandoned Vehicle",
    "HEAT/HOT WATER",
    None,
)
BOROUGH_TEXTS = (" africa", "America", "ASIA", "Europe ", "Middle East", "", None)

# Amounts have two decimals (an order's tip, price times discount, has four).
EXACT_MEASURES = tuple(m if m.unit else Measure(m.source, m.mean_as, digits=2) for m in TRIP_MEASURES)
ORDER_MEASURES = tuple(
    Measure(m.source, m.mean_as, digits=4) if m.source == "tip_amount" else m for m in EXACT_MEASURES
)


def mean_sql(x: str, digits: int = 2) -> str:
    """Mean of an amount with few decimals, summed as whole numbers."""
    scale = 10**digits
    return (
        f"CAST(SUM(CAST(floor({x} * CAST({scale} AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT)) AS DOUBLE)"
        f" / NULLIF(COUNT({x}) * CAST({scale} AS DOUBLE), 0)"
    )


# Order-to-ship "trips" last days, not minutes, and cost far more.
DAY_BOUNDS = {
    "trip_duration_s": Bound(0, 1000 * 86400, lo_open=True),
    "trip_distance": Bound(0, 45),
    "fare_amount": Bound(0, 90000),
    "total_amount": Bound(0, 450000),
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _with_k(events: DataFrame) -> DataFrame:
    """Add the number in props; a generator, so each object is parsed once however often k is used."""
    return events.select(*[c for c in events.columns if c != "props"], F.json_tuple("props", "k").alias("_k")).select(
        *[c for c in events.columns if c != "props"], F.col("_k").cast("int").alias("k")
    )


def _pick(values, index) -> Column:
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), index.cast("int"))


def zone_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as zones, regions (in small letters, padded) as boroughs."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_nationkey").cast("string").alias("LocationID"),
        F.concat(F.lit(" "), F.lower("r_name")).alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.concat(F.lit("Area "), F.col("r_regionkey").cast("string")).alias("service_zone"),
    )


LOOKUP_SQL = """lookup AS (
  SELECT n_nationkey AS id, ' ' || lower(r_name) AS borough, n_name AS zone,
         'Area ' || CAST(r_regionkey AS VARCHAR) AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def event_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Hour-grain trips: user group as zone, 30 zones of which the lookup knows 25."""
    k, fare = F.col("k"), F.col("value")
    tip = F.when(F.col("event_type") == "purchase", k.cast("double"))
    rows = _with_k(table(spark, sf, "events").filter(F.col("event_type").isin(*TRIP_EVENTS)))
    trips = rows.select(
        F.col("ts").alias("tpep_pickup_datetime"),
        F.timestamp_add("MINUTE", k, F.col("ts")).alias("tpep_dropoff_datetime"),
        (F.col("user_id") % 30).cast("int").alias("PULocationID"),
        (k / F.lit(4.0)).alias("trip_distance"),
        fare.alias("fare_amount"),
        (fare + F.coalesce(tip, F.lit(0.0))).alias("total_amount"),
        tip.alias("tip_amount"),
    )
    return conform(trips, TRIP)


EVENT_TRIPS_SQL = """trips AS (
  SELECT ts, CAST(user_id % 30 AS INTEGER) AS zone, k, k * 60 AS secs,
         CAST(k AS DOUBLE) / 4 AS distance, fare, tip, fare + COALESCE(tip, 0) AS total
  FROM (SELECT ts, user_id, k, value AS fare,
               CASE WHEN event_type = 'purchase' THEN CAST(k AS DOUBLE) END AS tip
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
              FROM events WHERE event_type IN ('view', 'click', 'purchase'))))"""

ZONE_HOURS_SQL = f"""{EVENT_TRIPS_SQL},
zone_hours AS (
  SELECT date_trunc('hour', ts) AS hour_ts, zone, COUNT(*) AS trips,
         CAST(SUM(secs) AS DOUBLE) / (COUNT(secs) * CAST(60 AS DOUBLE)) AS avg_trip_duration_min,
         {mean_sql('fare')} AS avg_fare_amount,
         {mean_sql('distance')} AS avg_trip_distance,
         {mean_sql('total')} AS avg_total_amount,
         {mean_sql('tip')} AS avg_tip_amount
  FROM trips
  WHERE secs > 0 AND secs <= 14400 AND distance BETWEEN 0 AND 200
    AND fare BETWEEN 0 AND 1000 AND total BETWEEN 0 AND 2000
  GROUP BY 1, 2)"""


def order_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Day-grain trips: each order line travels from order date to ship date."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"
    )
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    placed = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    rows = lines.join(placed, lines["l_orderkey"] == placed["o_orderkey"])
    trips = rows.select(
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.col("c_nationkey").alias("PULocationID"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("o_totalprice").alias("total_amount"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("tip_amount"),
    )
    return conform(trips, TRIP)


ORDER_TRIPS_SQL = """trips AS (
  SELECT o_orderdate AS pickup, l_shipdate AS dropoff, c_nationkey AS zone,
         date_diff('second', o_orderdate, l_shipdate) AS secs, l_quantity AS distance,
         l_extendedprice AS fare, o_totalprice AS total, l_extendedprice * l_discount AS tip
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
sane AS (
  SELECT * FROM trips
  WHERE zone IS NOT NULL AND secs > 0 AND secs <= 86400000 AND distance BETWEEN 0 AND 45
    AND fare BETWEEN 0 AND 90000 AND total BETWEEN 0 AND 450000)"""


def event_complaints(spark: SparkSession, sf: str) -> DataFrame:
    """Raw complaints with untidy borough labels, some of them blank or NULL."""
    rows = _with_k(table(spark, sf, "events").filter(F.col("event_type").isin(*COMPLAINT_EVENTS)))
    return rows.select(
        F.col("event_id").alias("unique_key"),
        F.col("ts").alias("created_date"),
        _pick(COMPLAINT_TEXTS, F.col("k") % 8).alias("complaint_type"),
        F.col("event_type").alias("descriptor"),
        _pick(BOROUGH_TEXTS, F.col("user_id") % 7).alias("borough"),
    )


def _sql_list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


COMPLAINTS_SQL = f"""complaints AS (
  SELECT event_id AS unique_key, ts AS created_date, event_type AS descriptor,
         ({_sql_list(COMPLAINT_TEXTS)})[CAST(json_extract_string(props, '$.k') AS INTEGER) % 8 + 1] AS complaint_type,
         ({_sql_list(BOROUGH_TEXTS)})[user_id % 7 + 1] AS borough
  FROM events WHERE event_type IN ('error', 'signup')),
complaint_hours AS (
  SELECT date_trunc('hour', created_date) AS hour_ts, upper(trim(borough)) AS borough,
         COUNT(*) AS complaints_total,
         COUNT(*) FILTER (regexp_matches(COALESCE(complaint_type, ''), '(?i)noise')) AS complaints_noise,
         COUNT(*) FILTER (regexp_matches(COALESCE(complaint_type, ''),
           '(?i)sanitation|unsanitary|garbage|rodent|pest')) AS complaints_sanitation,
         COUNT(*) FILTER (regexp_matches(COALESCE(complaint_type, ''),
           '(?i)street|traffic|transport|vehicle|parking')) AS complaints_transportation
  FROM complaints WHERE borough IS NOT NULL AND trim(borough) <> '' GROUP BY 1, 2)"""


def weather_rows(spark: SparkSession, sf: str, hourly: bool = False) -> DataFrame:
    """Raw weather: an observation for every event, or for the first of each hour."""
    events = table(spark, sf, "events")
    if hourly:
        events = dedup_by_key(events.withColumn("_hour", F.date_trunc("hour", "ts")), ["_hour"], "event_id")
    first = _with_k(events)
    k, value = F.col("k"), F.col("value")
    nanos = F.unix_micros(F.col("ts").cast("timestamp")) * 1000 + 999
    rows = first.select(
        nanos.alias("time"),
        value.alias("temp"),
        (value - k).alias("dwpt"),
        k.alias("rhum"),
        (k / 8.0).alias("prcp"),
        F.when(k % 2 == 0, k).alias("snow"),
        (k * 3).alias("wdir"),
        (F.col("user_id") % 50 / F.lit(2.0)).alias("wspd"),
        F.when(k % 5 > 0, value).alias("wpgt"),
        (k + 1000).alias("pres"),
        F.lit(None).cast("double").alias("tsun"),
        F.when(k > 0, F.col("event_id") % 28).alias("coco"),
    )
    return conform(rows, WEATHER)


# The weather texts are fixed values, see schemas.
_WEATHER_SQL = """weather_rows AS (
  SELECT epoch_us(ts) * 1000 + 999 AS time_ns, ts, value AS temp, value - k AS dwpt, CAST(k AS DOUBLE) AS rhum,
         CAST(k AS DOUBLE) / 8 AS prcp, CASE WHEN k % 2 = 0 THEN CAST(k AS DOUBLE) END AS snow,
         CAST(k * 3 AS DOUBLE) AS wdir, CAST(user_id % 50 AS DOUBLE) / 2 AS wspd, CASE WHEN k % 5 > 0 THEN value END AS wpgt,
         CAST(k + 1000 AS DOUBLE) AS pres, CAST(NULL AS DOUBLE) AS tsun,
         CASE WHEN k > 0 THEN CAST(event_id % 28 AS DOUBLE) END AS coco
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               ROW_NUMBER() OVER (PARTITION BY date_trunc('hour', ts) ORDER BY event_id) AS rn
        FROM events){where}),
weather AS (
  SELECT time_ns, time_ns // 1000 AS time_us, ts, date_trunc('hour', ts) AS hour_ts,
         temp, dwpt, rhum, prcp, snow, wdir, wspd, wpgt, pres, tsun, coco,
         CAST(CASE WHEN coco BETWEEN 7 AND 13 THEN coco ELSE 0 END AS INTEGER) AS rain_code,
         CASE coco WHEN 7 THEN 'Light rain' WHEN 8 THEN 'Rain' WHEN 9 THEN 'Heavy rain'
                   WHEN 10 THEN 'Freezing rain' WHEN 11 THEN 'Heavy freezing rain' WHEN 12 THEN 'Sleet'
                   WHEN 13 THEN 'Heavy sleet' ELSE 'No rain' END AS rain_text,
         CAST(CASE WHEN coco BETWEEN 15 AND 18 THEN coco ELSE 0 END AS INTEGER) AS snow_code,
         CASE coco WHEN 15 THEN 'Light snow' WHEN 16 THEN 'Snow' WHEN 17 THEN 'Heavy snow'
                   WHEN 18 THEN 'Snowstorm' ELSE 'No snow' END AS snow_text,
         CASE WHEN coco IN (9, 11, 13, 17, 18) OR wpgt > 20 THEN 1 ELSE 0 END AS extreme_weather
  FROM weather_rows)"""
WEATHER_SQL = _WEATHER_SQL.replace("{where}", "")
HOURLY_WEATHER_SQL = _WEATHER_SQL.replace("{where}", " WHERE rn = 1")


def region_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with the region of their customer, for daily series."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    places = zone_lookup(spark, sf).select(F.col("LocationID").cast("int"), F.upper(F.trim("Borough")).alias("borough"))
    rows = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    rows = rows.join(places, rows["c_nationkey"] == places["LocationID"])
    return rows.select("borough", "o_orderdate", F.lit(1).alias("trips"), F.col("o_totalprice").cast(MONEY).alias("price"))


REGION_ORDERS_SQL = """region_orders AS (
  SELECT r_name AS borough, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(18,2)) AS price
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

# One row per region and day of its span; days without orders have sum 0.
DAILY_SQL = f"""{REGION_ORDERS_SQL},
stored AS (
  SELECT borough, day, COUNT(*) AS trips, CAST(SUM(price) AS DOUBLE) / COUNT(price) / 1000 AS mean_price,
         CAST(MAX(price) AS DOUBLE) / 1000 AS max_price, CAST(SUM(price) AS DOUBLE) / 1000 AS revenue
  FROM region_orders GROUP BY 1, 2),
days AS (
  SELECT borough, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day
  FROM (SELECT borough, CAST(MIN(day) AS TIMESTAMP) AS lo, CAST(MAX(day) AS TIMESTAMP) AS hi
        FROM stored GROUP BY 1)),
daily AS (
  SELECT d.borough, d.day, CAST(COALESCE(trips, 0) AS BIGINT) AS trips, mean_price, max_price,
         COALESCE(revenue, 0) AS revenue
  FROM days d LEFT JOIN stored s ON d.borough = s.borough AND d.day = s.day),
seq AS (
  SELECT *, CAST(trips AS DOUBLE) AS y, ROW_NUMBER() OVER (PARTITION BY borough ORDER BY day) AS i,
         COUNT(*) OVER (PARTITION BY borough) AS n FROM daily)"""


def daily_series(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per region and day, with their mean and top price and revenue in thousands."""
    rows = region_orders(spark, sf).withColumns({c: F.col("price") for c in ("mean_price", "max_price", "revenue")})
    spec = {"trips": "sum", "mean_price": "mean", "max_price": "max", "revenue": "sum"}
    daily = resample_daily(rows, "o_orderdate", spec, ["borough"])
    return daily.withColumns({c: F.col(c).cast("double") / 1000 for c in ("mean_price", "max_price", "revenue")})
