"""Tables and views in Spark's catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def register_external(
    spark: SparkSession, name: str, path: str, merge_schema: bool = False, partitioned: bool = False
) -> DataFrame:
    """Table over files that stay where they are, in place of an earlier one; the schema is that of the files."""
    merge = "true" if merge_schema else "false"
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # an external table: its files stay
    spark.sql(f"CREATE TABLE {name} USING parquet OPTIONS (mergeSchema '{merge}') LOCATION '{location}'")
    refresh(spark, name, partitioned)
    return spark.table(name)


def refresh(spark: SparkSession, name: str, partitioned: bool = False) -> None:
    """Make files and folders added since visible."""
    if partitioned:
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def create_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Empty typed table, unless it exists."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet")


def publish_view(df: DataFrame, name: str) -> None:
    """Session view of a DataFrame."""
    df.createOrReplaceTempView(name)


def publish_sql_view(spark: SparkSession, name: str, sql: str) -> None:
    """View kept in the catalog; it may read tables but no session views."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def list_tables(spark: SparkSession, pattern: str | None = None) -> DataFrame:
    """Tables and views, by name pattern."""
    rows = [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables(pattern=pattern)]
    return spark.createDataFrame(rows, "name string, table_type string, is_temporary boolean")


def schema_differences(df: DataFrame, schema: T.StructType) -> list[str]:
    """What sets the table's columns apart from a layout; empty if nothing does."""
    have = {f.name.lower(): f.dataType for f in df.schema}
    want = {f.name.lower(): f.dataType for f in schema}
    out = [f"missing {n}" for n in want if n not in have]
    out += [f"extra {n}" for n in have if n not in want]
    out += [
        f"{n} is {have[n].simpleString()}, not {t.simpleString()}"
        for n, t in want.items()
        if n in have and have[n] != t
    ]
    return out
