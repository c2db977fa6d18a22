"""Tables that a plan reads more than once, kept in the folder all executors share."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; this cuts its lineage."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame, col: str = "text") -> int:
    """UTF-8 bytes of a text column, over all rows."""
    return docs.agg(F.sum(F.octet_length(col))).first()[0] or 0


def parts_for(spark: SparkSession, size: int, each: int) -> int:
    """How many parts of about ``each`` bytes hold ``size`` bytes; at least one per shuffle partition."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / each))
