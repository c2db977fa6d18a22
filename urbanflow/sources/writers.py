"""Writers.

Partitioned writes are preceded by a rebalance on the partition columns: rows
of one folder are brought together so that it gets few files, and AQE splits a
folder that is too large for one task, so a single large month does not become
a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTITIONS = ("year", "month")


def write_month(df: DataFrame, path: str, by: Sequence[str] = PARTITIONS) -> None:
    """Write months into a table, replacing those the input has and no others.

    A rerun therefore leaves the table as it was, where appending would double
    the month.
    """
    (
        _rebalance(df, by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_fact(df: DataFrame, path: str, by: Sequence[str] = PARTITIONS, cluster: bool = True) -> None:
    """Replace a partitioned table as a whole."""
    out = _rebalance(df, by) if cluster else df
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    """Replace an unpartitioned table."""
    df.write.mode("overwrite").parquet(path)


def export(df: DataFrame, path: str, max_rows_per_file: int | None = None) -> None:
    """Export a table as Parquet files."""
    w = df.write.mode("overwrite")
    if max_rows_per_file:
        w = w.option("maxRecordsPerFile", max_rows_per_file)
    w.parquet(path)


def save_as(df: DataFrame, name: str, by: Sequence[str] = ()) -> None:
    """Create or replace a catalog table from a query."""
    w = (_rebalance(df, by) if by else df).write.mode("overwrite").format("parquet")
    (w.partitionBy(*by) if by else w).saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Create or replace a catalog table bucketed and sorted by ``keys``, one file for each bucket.

    Tables of equal keys and bucket counts are joined and grouped on these keys
    without a shuffle.  ``path`` puts the files elsewhere than the warehouse.
    """
    w = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    (w.option("path", path) if path else w).saveAsTable(name)
    return df.sparkSession.table(name)


def _rebalance(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *[F.col(c) for c in by])
