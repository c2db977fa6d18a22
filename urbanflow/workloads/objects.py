"""Object columns and file paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import path_number
from ..operators.flatten import discover_keys, flatten_object, projection_text, rows_to_array
from .inputs import table
from .registry import query

# Each event as an object with three keys: its type, its type in capitals, and k.
OBJECTS_SQL = """objects AS (
  SELECT event_id, '{"' || event_type || '": "' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || '", "'
         || upper(event_type) || '": ' || CAST(user_id AS VARCHAR) || ', '
         || substr(props, 2) AS value
  FROM events)"""
NAMED_KEYS_SQL = f"""{OBJECTS_SQL},
named AS (
  SELECT key, key_norm, rn, 'v_' || key_norm || CASE WHEN rn > 1 THEN '_' || rn ELSE '' END AS column_name
  FROM (SELECT key, lower(key) AS key_norm,
               CAST(ROW_NUMBER() OVER (PARTITION BY lower(key) ORDER BY key) AS INTEGER) AS rn
        FROM (SELECT DISTINCT unnest(json_keys(CAST(value AS JSON))) AS key FROM objects)))"""


def objects(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    text = F.concat(
        F.lit('{"'), kind, F.lit('": "'), F.col("value").cast("decimal(18,2)").cast("string"), F.lit('", "'),
        F.upper(kind), F.lit('": '), F.col("user_id").cast("string"), F.lit(", "), F.expr("substr(props, 2)"),
    )
    return table(spark, sf, "events").select("event_id", text.alias("value"))


@query("q15_discover_keys", f"WITH {NAMED_KEYS_SQL} SELECT * FROM named")
def object_key_names(spark: SparkSession, sf: str) -> DataFrame:
    return discover_keys(objects(spark, sf), "value").select("key", "key_norm", "rn", "column_name")


# Objects whose keys differ in case only, look like numbered names, and hold dots, quotes and brackets.
ODD_SQL = r"""odd AS (
  SELECT event_id, '{"Trips": ' || user_id || ', "trips": "' || event_type || '", "trips_2": '
         || CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END || ', "a": {"b": 9}, "a.b": '
         || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || ', "it''s": '
         || CASE WHEN user_id % 3 = 0 THEN 'null' ELSE CAST(event_id AS VARCHAR) END || ', "say \"x\"": "'
         || event_type || '", "k[0]": [' || user_id || ', 1], "mixed": '
         || CASE WHEN user_id % 2 = 0 THEN '1' ELSE '"one"' END || '}' AS value
  FROM events)"""
# The number, column name and type of each key; a.b has as many digits as its longest number.
ODD_KEYS = """VALUES ('Trips', 'trips', 1, 'v_trips', 'bigint'), ('trips', 'trips', 2, 'v_trips_3', 'string'),
    ('trips_2', 'trips_2', 1, 'v_trips_2', 'boolean'), ('a', 'a', 1, 'v_a', 'string'), ('a.b', 'a.b', 1, 'v_a.b', NULL),
    ('it''s', 'it''s', 1, 'v_it''s', 'bigint'), ('say "x"', 'say "x"', 1, 'v_say "x"', 'string'),
    ('k[0]', 'k[0]', 1, 'v_k[0]', 'array<bigint>'), ('mixed', 'mixed', 1, 'v_mixed', 'string')"""
ODD_NAMED_SQL = f"""{ODD_SQL},
wide AS (
  SELECT 'decimal(' || (2 + MAX(length(CAST(CAST(trunc(abs(CAST(json_extract_string(value, '/a.b') AS DOUBLE))) AS BIGINT) AS VARCHAR)))) || ',2)' AS kind
  FROM odd),
named AS (
  SELECT n.key, key_norm, CAST(rn AS INTEGER) AS rn, column_name, COALESCE(type, (SELECT kind FROM wide)) AS type
  FROM (SELECT DISTINCT unnest(json_keys(CAST(value AS JSON))) AS key FROM odd) k
  JOIN ({ODD_KEYS}) AS n(key, key_norm, rn, column_name, type) ON n.key = k.key)"""


def odd_objects(spark: SparkSession, sf: str) -> DataFrame:
    flag = F.when(F.col("user_id") % 2 == 0, "true").otherwise("false")
    number = F.when(F.col("user_id") % 3 == 0, "null").otherwise(F.col("event_id").cast("string"))
    mixed = F.when(F.col("user_id") % 2 == 0, "1").otherwise('"one"')
    user, kind = F.col("user_id").cast("string"), F.col("event_type")
    text = F.concat(
        F.lit('{"Trips": '), user, F.lit(', "trips": "'), kind, F.lit('", "trips_2": '), flag, F.lit(', "a": {"b": 9}, "a.b": '),
        F.col("value").cast("decimal(18,2)").cast("string"), F.lit(', "it\'s": '), number, F.lit(', "say \\"x\\"": "'), kind,
        F.lit('", "k[0]": ['), user, F.lit(', 1], "mixed": '), mixed, F.lit("}"),
    )
    return table(spark, sf, "events").select("event_id", text.alias("value"))


@query("q15_variant_keys", f"WITH {ODD_NAMED_SQL} SELECT * FROM named")
def variant_keys(spark: SparkSession, sf: str) -> DataFrame:
    objects = odd_objects(spark, sf).select(F.parse_json("value").alias("value"))
    return discover_keys(objects, "value", typed=True).select("key", "key_norm", "rn", "column_name", "type")


PROJECTION_SQL = rf"""
WITH {ODD_NAMED_SQL},
quoted AS (
  SELECT *, CASE WHEN contains(key, '"') THEN '$[\''' || key || '\'']' ELSE '$["' || replace(key, '''', '\''') || '"]' END AS path
  FROM named)
SELECT string_agg('try_variant_get(try_parse_json(value), ''' || path || ''', ''' || type || ''') AS `' || column_name || '`',
                  chr(44) || chr(10) ORDER BY key_norm, rn) AS projection FROM quoted"""


@query("q15_projection_text", PROJECTION_SQL)
def object_projection(spark: SparkSession, sf: str) -> DataFrame:
    return projection_text(discover_keys(odd_objects(spark, sf), "value", typed=True), "try_parse_json(value)")


@query(
    "q16_variant_columns",
    f"""
WITH {ODD_SQL}
SELECT event_id, CAST(json_extract_string(value, '/Trips') AS BIGINT) AS trips, json_extract_string(value, '/trips') AS trips_3,
       CAST(json_extract_string(value, '/trips_2') AS BOOLEAN) AS trips_2, json_extract_string(value, '/a') AS a,
       CAST(json_extract_string(value, '/a.b') AS DOUBLE) AS a_b, CAST(json_extract_string(value, '/it''s') AS BIGINT) AS its,
       json_extract_string(value, '/say "x"') AS say_x,
       CAST(json_extract_string(value, '/k[0]/0') AS BIGINT) + CAST(json_extract_string(value, '/k[0]/1') AS BIGINT) AS k_sum,
       json_extract_string(value, '/mixed') AS mixed
FROM odd""",
)
def variant_columns(spark: SparkSession, sf: str) -> DataFrame:
    flat = flatten_object(odd_objects(spark, sf), "value", typed=True)
    k_sum = F.aggregate("`v_k[0]`", F.lit(0).cast("long"), lambda a, b: a + b)
    return flat.select(
        "event_id", F.col("v_trips").alias("trips"), F.col("v_trips_3").alias("trips_3"), F.col("v_trips_2").alias("trips_2"),
        F.col("v_a").alias("a"), F.col("`v_a.b`").cast("double").alias("a_b"), F.col("`v_it's`").alias("its"),
        F.col('`v_say "x"`').alias("say_x"), k_sum.alias("k_sum"), F.col("v_mixed").alias("mixed"),
    )


_TYPES = ("click", "error", "purchase", "signup", "view")
_FLAT_SQL = ",\n".join(
    f"""  json_extract_string(value, '$.{t.upper()}') AS v_{t}, json_extract_string(value, '$.{t}') AS v_{t}_2"""
    for t in _TYPES
)


@query(
    "q16_flatten_object",
    f"WITH {OBJECTS_SQL} SELECT event_id, json_extract_string(value, '$.k') AS v_k,\n{_FLAT_SQL} FROM objects",
)
def flattened_objects(spark: SparkSession, sf: str) -> DataFrame:
    return flatten_object(objects(spark, sf), "value")


PATHS_SQL = """paths AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'landing/part-0.parquet'
         ELSE 'master/year=' || year(o_orderdate) || '/month=' || month(o_orderdate) || '/part-0.parquet' END AS path
  FROM orders)"""


def paths(spark: SparkSession, sf: str) -> DataFrame:
    placed = F.concat(
        F.lit("master/year="), F.year("o_orderdate").cast("string"),
        F.lit("/month="), F.month("o_orderdate").cast("string"), F.lit("/part-0.parquet"),
    )
    path = F.when(F.col("o_orderstatus") == "P", "landing/part-0.parquet").otherwise(placed)
    return table(spark, sf, "orders").select("o_orderkey", path.alias("path"))


@query(
    "q36_path_numbers",
    f"""
WITH {PATHS_SQL}
SELECT o_orderkey, TRY_CAST(NULLIF(regexp_extract(path, 'year=([0-9]+)', 1), '') AS INTEGER) AS year,
       TRY_CAST(NULLIF(regexp_extract(path, 'month=([0-9]+)', 1), '') AS INTEGER) AS month FROM paths""",
)
def path_numbers(spark: SparkSession, sf: str) -> DataFrame:
    rows = paths(spark, sf)
    return rows.select("o_orderkey", path_number("path", "year").alias("year"), path_number("path", "month").alias("month"))


@query(
    "q36_rows_to_array",
    """
SELECT ym, CAST(COUNT(*) AS INTEGER) AS n_items,
       string_agg(o_orderstatus || ':' || n, ',' ORDER BY o_orderstatus) AS items
FROM (SELECT strftime(o_orderdate, '%Y-%m') AS ym, o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1""",
)
def status_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per month as an array with one item per status."""
    ym = F.date_format("o_orderdate", "yyyy-MM").alias("ym")
    counts = table(spark, sf, "orders").groupBy(ym, "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    arrays = rows_to_array(counts, ["ym"], ["o_orderstatus", "n"])
    text = F.transform("items", lambda i: F.concat_ws(":", i["o_orderstatus"], i["n"].cast("string")))
    return arrays.select("ym", F.size("items").alias("n_items"), F.array_join(text, ",").alias("items"))
