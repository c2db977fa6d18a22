"""Captures and dated lists made of the pages table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .url_filters import host_of

# (list, rule, pattern, divisor, remainder, action, day): for hosts whose number leaves that remainder; day counts from 2024-01-01
# and goes up by the host's number.
CHANGES = [
    ("harmful", "domain", "host", 3, 0, "add", 5),
    ("harmful", "domain", "host", 3, 0, "remove", 65),
    ("harmful", "domain", "host", 3, 0, "add", 155),
    ("tracking", "prefix", "host || '/en'", 2, 0, "add", 30),
    ("tracking", "prefix", "host || '/en'", 2, 0, "add", 90),
    ("tracking", "prefix", "host || '/en'", 2, 0, "remove", 200),
    ("allow", "prefix", "host || '/fr'", 5, 1, "add", 40),
    ("spam", "domain", "regexp_extract(host, '([^.]+[.][^.]+[.][^.]+)$', 1)", 7, 2, "add", 100),
    ("spam", "domain", "regexp_extract(host, '([^.]+[.][^.]+[.][^.]+)$', 1)", 7, 2, "remove", 130),
]


def captures(pages: DataFrame) -> DataFrame:
    """Every page with a fetch time made of its id."""
    day = F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(cast(page_id * 7919 % 365 as int), cast(page_id % 24 as int))")
    return pages.select("page_id", "url", day.alias("fetched"))


def entries(pages: DataFrame) -> DataFrame:
    """The lists' changes; a host's number is its least page_id mod 97."""
    hosts = pages.select(host_of(F.col("url")).alias("host"), "page_id").where("host is not null and page_id is not null")
    hosts = hosts.groupBy("host").agg(F.min("page_id").alias("least")).withColumn("number", F.expr("least % 97"))
    out = None
    for name, rule, pattern, divisor, remainder, action, day in CHANGES:
        at = F.expr(f"timestamp'2024-01-01 00:00:00' + make_dt_interval(cast({day} + number as int))")
        part = hosts.where(f"number % {divisor} = {remainder}").select(
            F.lit(name).alias("list"), F.lit(rule).alias("rule"), F.expr(pattern).alias("pattern"), F.lit(action).alias("action"), at.alias("at")
        )
        part = part.where("pattern <> ''")
        out = part if out is None else out.union(part)
    return out


_HOST = r"regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)', 1)), '\.+$', '')"
_PATH = r"regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/+$', '')"
_PARTS = " UNION ALL ".join(
    f"SELECT '{name}' AS name, '{rule}' AS rule, {pattern} AS pattern, '{action}' AS action, "
    f"TIMESTAMP '2024-01-01' + to_days(CAST({day} + number AS INT)) AS since FROM hosts WHERE number % {divisor} = {remainder}"
    for name, rule, pattern, divisor, remainder, action, day in CHANGES
)
SQL = f"""
WITH rows AS (
  SELECT page_id, url, nullif({_HOST}, '') AS host, {_PATH} AS path,
    TIMESTAMP '2024-01-01' + to_days(CAST(page_id * 7919 % 365 AS INT)) + to_hours(page_id % 24) AS fetched
  FROM pages
), hosts AS (
  SELECT host, min(page_id) % 97 AS number FROM rows WHERE host IS NOT NULL GROUP BY host
), changes AS (
  SELECT *, lag(action) OVER (PARTITION BY name, rule, pattern ORDER BY since, action) AS before FROM ({_PARTS}) WHERE pattern <> ''
), spans AS (
  SELECT *, lead(since) OVER (PARTITION BY name, rule, pattern ORDER BY since, action) AS until
  FROM changes WHERE action <> coalesce(before, 'remove')
), met AS (
  SELECT r.url, r.fetched, list(DISTINCT s.name ORDER BY s.name) AS names
  FROM (SELECT DISTINCT url, host, path, fetched FROM rows WHERE host IS NOT NULL) r JOIN spans s
    ON s.action = 'add' AND r.fetched >= s.since AND (s.until IS NULL OR r.fetched < s.until)
    AND CASE s.rule WHEN 'domain' THEN r.host = s.pattern OR ends_with(r.host, '.' || s.pattern)
      ELSE r.host || r.path = s.pattern OR starts_with(r.host || r.path, s.pattern || '/') END
  GROUP BY r.url, r.fetched
)
SELECT page_id, r.url, r.fetched, host, coalesce(array_to_string(names, ','), '') AS lists,
  coalesce(len(list_filter(names, lambda x: x <> 'allow')) > 0 AND NOT list_contains(names, 'allow'), FALSE) AS blocked
FROM rows r LEFT JOIN met USING (url, fetched)
"""
