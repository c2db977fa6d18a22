"""Row counts, ranges, audits and landing checks; each is one pass over its input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.times import bucket


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def time_range(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.min(ts).alias(f"min_{ts}"), F.max(ts).alias(f"max_{ts}"))


def flag_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with the flag set, for those flags the table has."""
    return df.agg(*_flags(df, cols))


def null_audit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULLs per column, e.g. rows a dimension join left unmatched."""
    return df.agg(*_nulls(cols))


def table_check(df: DataFrame, ts: str, flags: Sequence[str] = (), nulls: Sequence[str] = ()) -> DataFrame:
    """Row count, time range, flag counts and NULL counts as one row."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(ts).alias(f"min_{ts}"),
        F.max(ts).alias(f"max_{ts}"),
        *_flags(df, flags),
        *_nulls(nulls),
    )


def _flags(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    return [F.count_if(F.col(c) == 1).alias(f"{c}_rows") for c in cols if c in df.columns]


def _nulls(cols: Sequence[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols]


def value_counts(df: DataFrame, col: str, ordered: bool = True) -> DataFrame:
    """Rows per value, most frequent first."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(col)) if ordered else counts


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def distinct_count(df: DataFrame, *cols: str) -> DataFrame:
    """Distinct non-NULL values per column; repeats are removed in the map tasks."""
    return df.agg(*[F.count_distinct(F.col(c)).alias(f"distinct_{c}") for c in cols])


def top_n(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First n rows of an order; each task keeps n rows, nothing is fully sorted."""
    return df.orderBy(*order).limit(n)


def sample_rows(df: DataFrame, n: int) -> DataFrame:
    """Any n rows, for a look at a table."""
    return df.limit(n)


def audit_funnel(
    df: DataFrame,
    tag: str,
    ts: str,
    key: str,
    in_scope: Column,
    grain: str = "hour",
) -> DataFrame:
    """How many rows of each delivery survive each cleaning step.

    Per value of ``tag``: raw rows, NULL times, rows in scope, NULL keys among
    those, rows kept (in scope with a key), groups they form per time bucket
    and key, and the range of their buckets.  NULL times are counted before
    anything is filtered.

    Rows are first combined per (tag, bucket, key), which yields the group
    count without a distinct count, then per tag: one scan, and no reducer
    sees a whole delivery.
    """
    scoped = F.coalesce(in_scope, F.lit(False))
    kept = scoped & F.col(key).isNotNull()
    groups = (
        df.groupBy(F.col(tag), bucket(ts, grain).alias("_bucket"), F.col(key).alias("_key"))
        .agg(
            F.count(F.lit(1)).alias("raw_rows"),
            F.count_if(F.col(ts).isNull()).alias("null_time_rows"),
            F.count_if(scoped).alias("in_scope_rows"),
            F.count_if(scoped & F.col(key).isNull()).alias("null_key_rows"),
            F.count_if(kept).alias("kept_rows"),
        )
    )
    has_rows = F.col("kept_rows") > 0
    sums = ["raw_rows", "null_time_rows", "in_scope_rows", "null_key_rows", "kept_rows"]
    return groups.groupBy(tag).agg(
        *[F.sum(c).alias(c) for c in sums],
        F.count_if(has_rows).alias("group_rows"),
        F.min(F.when(has_rows, F.col("_bucket"))).alias("min_bucket"),
        F.max(F.when(has_rows, F.col("_bucket"))).alias("max_bucket"),
    )


def landing_gaps(
    expected: DataFrame,
    landed: DataFrame,
    keys: Sequence[str],
    expected_rows: str = "expected_rows",
    landed_rows: str = "landed_rows",
) -> DataFrame:
    """Expected deliveries that are missing or incomplete.

    Both sides hold one row per delivery.  ``status`` is ``missing``,
    ``short`` or ``over``; complete deliveries are left out.
    """
    have, want = F.coalesce(F.col(landed_rows), F.lit(0)), F.col(expected_rows)
    status = (
        F.when(F.col(landed_rows).isNull(), "missing").when(have < want, "short").when(have > want, "over")
    )
    return (
        expected.select(*keys, expected_rows)
        .join(landed.select(*keys, landed_rows), list(keys), "left")
        .select(*keys, expected_rows, have.alias(landed_rows), status.alias("status"))
        .filter(F.col("status").isNotNull())
    )


def expected_months(spark: SparkSession, months: Sequence[tuple[int, int]], tag: str = "ym") -> DataFrame:
    """One row per month that should have landed."""
    return spark.createDataFrame([(f"{y:04d}-{m:02d}",) for y, m in months], f"{tag} string")


def missing_months(expected: DataFrame, landed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected deliveries without a single landed row.

    Landed keys are made distinct in the map tasks first, so what is joined
    grows with the deliveries, not with their rows.
    """
    return expected.join(landed.select(*keys).distinct(), list(keys), "left_anti")


def dedup_by_key(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark applies ``row_number() <= 1`` inside each map task before it
    shuffles, so a key with very many copies sends one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")

