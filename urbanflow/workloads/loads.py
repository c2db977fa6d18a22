"""Files, layouts, views and small checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import get_path
from ..operators.project import require, select_except
from ..operators.quality import flag_counts, row_count, time_range
from ..schemas import layout
from ..session import shared_folder
from ..sources.catalog import publish_view
from ..sources.inference import infer, read_drifting
from ..sources.readers import file_inventory, load_by_name, read_by_path
from ..sources.writers import write_fact
from .inputs import table
from .objects import OBJECTS_SQL, objects
from .registry import query


@query("q37_event_files", "SELECT 'events.parquet' AS file, COUNT(*) AS rows FROM events")
def event_files(spark: SparkSession, sf: str) -> DataFrame:
    files = file_inventory(table(spark, sf, "events"))
    return files.select(F.element_at(F.split("file_path", "/"), -1).alias("file"), "rows")


@query(
    "q38_load_by_name",
    """
SELECT o_totalprice AS O_TOTALPRICE, o_orderkey AS O_ORDERKEY, CAST(o_custkey AS VARCHAR) AS O_CUSTKEY,
       CAST(NULL AS VARCHAR) AS O_NOTE FROM orders""",
)
def orders_by_name(spark: SparkSession, sf: str) -> DataFrame:
    wanted = layout("O_TOTALPRICE double, O_ORDERKEY bigint, O_CUSTKEY string, O_NOTE string")
    return load_by_name(spark, f"{sf}/orders.parquet", wanted)


@query("q39_published_view", "SELECT o_orderstatus, COUNT(*) AS orders FROM orders WHERE o_totalprice > 1000 GROUP BY 1")
def published_view(spark: SparkSession, sf: str) -> DataFrame:
    publish_view(table(spark, sf, "orders").where("o_totalprice > 1000"), "urbanflow_large_orders")
    return spark.table("urbanflow_large_orders").groupBy("o_orderstatus").agg(F.count("*").alias("orders"))


@query(
    "q40_object_paths",
    f"WITH {OBJECTS_SQL} SELECT event_id, json_extract_string(value, '$.k') AS k FROM objects",
)
def object_paths(spark: SparkSession, sf: str) -> DataFrame:
    return select_except(objects(spark, sf).withColumn("k", get_path("value", "$.k")), ["value", "absent"])


@query("q41_required_rows", "SELECT COUNT(*) AS events FROM events")
def required_rows(spark: SparkSession, sf: str) -> DataFrame:
    return row_count(require(table(spark, sf, "events"), ["ts", "value"]), "events")


@query("q42_time_range", "SELECT MIN(ts) AS min_ts, MAX(ts) AS max_ts FROM events")
def event_range(spark: SparkSession, sf: str) -> DataFrame:
    return time_range(table(spark, sf, "events"), "ts")


@query(
    "q42_flag_counts",
    """
SELECT COUNT(*) FILTER (event_type = 'error') AS errors_rows, COUNT(*) FILTER (value > 50) AS large_rows FROM events""",
)
def event_flags(spark: SparkSession, sf: str) -> DataFrame:
    errors, large = (F.col("event_type") == "error").cast("int"), (F.col("value") > 50).cast("int")
    flags = table(spark, sf, "events").select(errors.alias("errors"), large.alias("large"))
    return flag_counts(flags, ["errors", "large", "absent"])


DRIFTED_SQL = """
SELECT CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderstatus ELSE 'rest' END AS status, o_orderkey,
       CAST(o_custkey AS DOUBLE) AS o_custkey, o_orderdate AS placed,
       CASE WHEN o_orderstatus = 'F' THEN left(o_orderpriority, 1) ELSE o_orderpriority END AS priority
FROM orders"""


@query("q43_drifting_files", DRIFTED_SQL)
def drifting_files(spark: SparkSession, sf: str) -> DataFrame:
    """Orders landed in folders whose column types drift, read back as one table."""
    orders, root = table(spark, sf, "orders"), f"{shared_folder(spark)}/drifting-{uuid.uuid4().hex}"
    status, key = F.col("o_orderstatus"), F.col("o_custkey")
    day, priority = F.col("o_orderdate"), F.col("o_orderpriority")
    landed = {
        "F": (status == "F", key.cast("int"), day.cast("date"), F.substring(priority, 1, 1).cast("smallint")),
        "O": (status == "O", key.cast("bigint"), day, priority),
        "rest": (~F.coalesce(status.isin("F", "O"), F.lit(False)), key.cast("double"), day, priority),
    }
    for name, (rows, k, placed, prio) in landed.items():
        rows = orders.where(rows).select("o_orderkey", k.alias("o_custkey"), placed.alias("placed"), prio.alias("priority"))
        rows.write.parquet(f"{root}/status={name}")
    return read_drifting(spark, infer(spark, root))


@query(
    "q44_files_by_path",
    """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, COUNT(*) AS orders,
       MIN(o_orderkey) AS first_key, MAX(o_orderkey) AS last_key
FROM orders WHERE year(o_orderdate) = 1995 AND month(o_orderdate) <= 6 GROUP BY 1, 2""",
)
def files_by_path(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of half a year, from those files alone whose paths say so."""
    root = f"{shared_folder(spark)}/by-month-{uuid.uuid4().hex}"
    dated = table(spark, sf, "orders").withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    write_fact(dated, root)
    rows = read_by_path(spark, root, "year = 1995 AND month <= 6")
    keys = [F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key")]
    return rows.groupBy("year", "month").agg(F.count(F.lit(1)).alias("orders"), *keys)
