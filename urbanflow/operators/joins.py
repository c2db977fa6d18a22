"""Dimension joins.

No join carries a broadcast hint.  Spark broadcasts a side only while its size,
estimated and then measured, is below spark.sql.autoBroadcastJoinThreshold; a
larger one is joined by sort-merge, whose skewed partitions AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import label


def zone_to_borough(lookup: DataFrame) -> DataFrame:
    """Zone id and canonical borough label of a lookup."""
    return lookup.select(
        F.col("LocationID").try_cast("int").alias("LocationID"), label("Borough").alias("borough")
    ).filter(F.col("LocationID").isNotNull() & F.col("borough").isNotNull())


def attach_borough(facts: DataFrame, lookup: DataFrame, zone: str = "PULocationID") -> DataFrame:
    """Add the borough of each zone; rows of zones without a borough are dropped.

    A zone that the lookup lists twice would double its trips and fails the job.
    """
    zones = one_row_per_key(zone_to_borough(lookup), ["LocationID"])
    return facts.join(zones, facts[zone] == zones["LocationID"], "inner").drop("LocationID")


def attach_zone_names(facts: DataFrame, lookup: DataFrame, zone: str = "PULocationID") -> DataFrame:
    """Add borough, zone and service zone; rows of unlisted zones keep NULL names."""
    names = lookup.select(
        F.col("LocationID").try_cast("int").alias("locationid"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        F.col("service_zone"),
    ).filter(F.col("locationid").isNotNull())
    names = one_row_per_key(names, ["locationid"])
    # The key keeps a private name until the join is done: zone and locationid
    # may differ only in case.
    left = facts.withColumnRenamed(zone, "_zone_key")
    return left.join(names, left["_zone_key"] == names["locationid"], "left").drop("locationid").withColumnRenamed(
        "_zone_key", "locationid"
    )


def one_row_per_key(df: DataFrame, keys: Sequence[str], duplicates: str = "error") -> DataFrame:
    """Guard a join side against fan-out.

    ``keep`` changes nothing, ``error`` fails the job on a repeated key.  Rows
    with a NULL key match nothing and are dropped.  The check is a window over
    the key inside the plan: it needs the partitioning the join needs anyway.
    """
    if duplicates == "keep":
        return df
    if duplicates != "error":
        raise ValueError(f"unknown choice: {duplicates}")
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    failure = F.raise_error(F.lit(f"repeated key in {list(keys)}")).cast("boolean")
    rows = df.dropna(subset=list(keys)).withColumn("_n", n)
    # the key itself stays as it is, so a join can use the partitioning its table has
    return rows.where(F.when(F.col("_n") > 1, failure).otherwise(True)).select(*df.columns)
