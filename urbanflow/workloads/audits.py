"""Counts, audits and landing checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import month_tag
from ..operators.quality import (
    audit_funnel,
    dedup_by_key,
    distinct_count,
    distinct_values,
    landing_gaps,
    missing_months,
    null_audit,
    table_check,
    value_counts,
)
from ..plans.backfill import backfill
from ..session import shared_folder
from .inputs import EVENT_TRIPS_SQL, event_trips, table
from .registry import query
from .tables import MASTER_SQL, NAMED_SQL, master_table, named_facts


@query(
    "q18_monthly_funnel",
    """
WITH deliveries AS (
  SELECT strftime(o_orderdate - INTERVAL 3 DAY, '%Y-%m') AS ym,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderdate END AS placed,
         NULLIF(o_custkey % 26, 25) AS zone
  FROM orders),
marked AS (
  SELECT *, COALESCE(strftime(placed, '%Y-%m') = ym, FALSE) AS ok FROM deliveries)
SELECT ym, COUNT(*) AS raw_rows, COUNT(*) FILTER (placed IS NULL) AS null_time_rows,
       COUNT(*) FILTER (ok) AS in_scope_rows, COUNT(*) FILTER (ok AND zone IS NULL) AS null_key_rows,
       COUNT(*) FILTER (ok AND zone IS NOT NULL) AS kept_rows,
       COUNT(DISTINCT CASE WHEN ok AND zone IS NOT NULL THEN (placed, zone) END) AS group_rows,
       MIN(placed) FILTER (ok AND zone IS NOT NULL) AS min_bucket,
       MAX(placed) FILTER (ok AND zone IS NOT NULL) AS max_bucket
FROM marked GROUP BY 1""",
)
def monthly_funnel(spark: SparkSession, sf: str) -> DataFrame:
    lost = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    deliveries = table(spark, sf, "orders").select(
        month_tag(F.col("o_orderdate") - F.expr("INTERVAL 3 DAYS")).alias("ym"),
        F.when(~lost, F.col("o_orderdate")).alias("placed"),
        F.nullif(F.col("o_custkey") % 26, F.lit(25)).alias("zone"),
    )
    return audit_funnel(deliveries, "ym", "placed", "zone", month_tag("placed") == F.col("ym"), "day")


@query(
    "q18_written_funnel",
    f"""
WITH {EVENT_TRIPS_SQL},
deliveries AS (
  SELECT strftime(ts - INTERVAL 3 DAY, '%Y-%m') AS ym, CASE WHEN k % 10 <> 9 THEN ts END AS placed,
         NULLIF(zone, 29) AS zone, secs, distance, fare, total
  FROM trips),
marked AS (
  SELECT *, date_trunc('hour', placed) AS hour_ts, COALESCE(strftime(placed, '%Y-%m') = ym, FALSE) AS ok,
         ok AND zone IS NOT NULL AS kept,
         kept AND secs > 0 AND secs <= 14400 AND distance BETWEEN 0 AND 200 AND fare BETWEEN 0 AND 1000
           AND total BETWEEN 0 AND 2000 AS sane
  FROM deliveries)
SELECT ym, COUNT(*) AS raw_rows, COUNT(*) FILTER (placed IS NULL) AS null_time_rows,
       COUNT(*) FILTER (ok) AS in_scope_rows, COUNT(*) FILTER (ok AND zone IS NULL) AS null_key_rows,
       COUNT(*) FILTER (kept) AS kept_rows, COUNT(*) FILTER (sane) AS sane_rows,
       COUNT(DISTINCT CASE WHEN kept THEN (hour_ts, zone) END) AS group_rows,
       COUNT(DISTINCT CASE WHEN sane THEN (hour_ts, zone) END) AS written_rows,
       MIN(hour_ts) FILTER (kept) AS min_bucket, MAX(hour_ts) FILTER (kept) AS max_bucket
FROM marked GROUP BY 1""",
)
def written_funnel(spark: SparkSession, sf: str) -> DataFrame:
    """Event trips landed in monthly folders, three days late, and the funnel that their backfill returns."""
    landing, facts = (f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}" for name in ("landing", "facts"))
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    trips = event_trips(spark, sf).withColumns(
        {
            "ym": month_tag(pickup - F.expr("INTERVAL 3 DAYS")),
            "tpep_pickup_datetime": F.when((F.col("trip_distance") * 4) % 10 != 9, pickup),
            "tpep_dropoff_datetime": F.when((F.col("trip_distance") * 4) % 10 != 9, dropoff),
            "PULocationID": F.nullif(F.col("PULocationID"), F.lit(29)),
        }
    )
    trips.write.partitionBy("ym").parquet(landing)
    tags = [r["ym"] for r in trips.select("ym").distinct().collect()]  # a row for each month
    months = [(int(ym[:4]), int(ym[5:])) for ym in sorted(tags)]
    return backfill(spark, landing, months, facts, template="ym={year:04d}-{month:02d}").funnel_rows(spark)


@query(
    "q20_master_check",
    f"""
WITH {MASTER_SQL}
SELECT COUNT(*) AS rows, MIN(hour_ts) AS min_hour_ts, MAX(hour_ts) AS max_hour_ts,
       COUNT(*) FILTER (rain = 1) AS rain_rows, COUNT(*) FILTER (snow = 1) AS snow_rows,
       COUNT(*) FILTER (extreme_weather = 1) AS extreme_weather_rows,
       COUNT(*) FILTER (snow_total IS NULL) AS null_snow_total,
       COUNT(*) FILTER (avg_tip_amount IS NULL) AS null_avg_tip_amount FROM master""",
)
def master_check(spark: SparkSession, sf: str) -> DataFrame:
    flags = ["rain", "snow", "extreme_weather", "hail"]
    return table_check(master_table(spark, sf), "hour_ts", flags, ["snow_total", "avg_tip_amount"])


@query(
    "q20_unmatched_zones",
    f"""
WITH {NAMED_SQL}
SELECT COUNT(*) FILTER (borough IS NULL) AS null_borough, COUNT(*) FILTER (zone IS NULL) AS null_zone,
       COUNT(*) FILTER (service_zone IS NULL) AS null_service_zone FROM named""",
)
def unmatched_zones(spark: SparkSession, sf: str) -> DataFrame:
    return null_audit(named_facts(spark, sf), ["borough", "zone", "service_zone"])


@query("q21_value_counts", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1 ORDER BY 2 DESC, 1")
def event_counts(spark: SparkSession, sf: str) -> DataFrame:
    return value_counts(table(spark, sf, "events"), "event_type")


@query(
    "q21_distinct_count",
    "SELECT COUNT(DISTINCT user_id) AS distinct_user_id, COUNT(DISTINCT event_type) AS distinct_event_type FROM events",
)
def event_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_count(table(spark, sf, "events"), "user_id", "event_type")


@query("q21_distinct_values", "SELECT DISTINCT props FROM events")
def event_props(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_values(table(spark, sf, "events"), "props")


# The manifest of a month is its orders; what landed are the orders with lines.
def _deliveries(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    lines = table(spark, sf, "lineitem").select("l_orderkey").distinct()  # an order with very many lines weighs one row
    keys = [month_tag("o_orderdate").alias("ym"), F.col("o_orderstatus")]
    expected = orders.groupBy(*keys).agg(F.count(F.lit(1)).alias("expected_rows"))
    arrived = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left_semi")
    return expected, arrived.groupBy(*keys).agg(F.count(F.lit(1)).alias("landed_rows"))


DELIVERIES_SQL = """expected AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS ym, o_orderstatus, COUNT(*) AS expected_rows FROM orders GROUP BY 1, 2),
landed AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS ym, o_orderstatus, COUNT(*) AS landed_rows FROM orders
  WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1, 2)"""


@query(
    "q34_landing_gaps",
    f"""
WITH {DELIVERIES_SQL}
SELECT ym, o_orderstatus, expected_rows, COALESCE(landed_rows, 0) AS landed_rows,
       CASE WHEN landed_rows IS NULL THEN 'missing' WHEN landed_rows < expected_rows THEN 'short' ELSE 'over' END AS status
FROM expected LEFT JOIN landed USING (ym, o_orderstatus)
WHERE landed_rows IS DISTINCT FROM expected_rows""",
)
def order_landing_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return landing_gaps(*_deliveries(spark, sf), ["ym", "o_orderstatus"])


@query(
    "q34_missing_days",
    """
SELECT day FROM (SELECT CAST(unnest(generate_series(MIN(o_orderdate), MAX(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS day
                 FROM orders)
WHERE day NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""",
)
def missing_days(spark: SparkSession, sf: str) -> DataFrame:
    days = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    span = days.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    expected = span.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    return missing_months(expected, days, ["day"])


@query(
    "q35_dedup",
    """
SELECT event_id, ts, user_id, event_type, copy FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY ts, copy) AS rn
  FROM (SELECT *, 1 AS copy FROM events UNION ALL SELECT *, 2 AS copy FROM events)) WHERE rn = 1""",
)
def dedup_events(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    landed = events.withColumn("copy", F.lit(2)).unionByName(events.withColumn("copy", F.lit(1)))
    return dedup_by_key(landed, ["event_id"], "ts", "copy").select("event_id", "ts", "user_id", "event_type", "copy")


@query(
    "q35_first_event_per_type",
    """
SELECT event_type, event_id, ts, value FROM (
  SELECT event_type, event_id, ts, value, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rn
  FROM events) WHERE rn = 1""",
)
def first_event_per_type(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_type", "event_id", "ts", "value")
    return dedup_by_key(events, ["event_type"], F.desc("value"), "event_id")
