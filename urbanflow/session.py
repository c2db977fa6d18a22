"""Session settings the plans are designed for."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Wall-clock hours are kept without a zone, so the session zone must not shift
# them.  Adaptive execution splits skewed join sides, coalesces small shuffle
# partitions, and turns a sort-merge join into a broadcast join only once the
# measured size of a side is below spark.sql.autoBroadcastJoinThreshold.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "urbanflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share.

    A cluster must name it.  Only a session on one machine gets a folder of
    its own where the setting is missing.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        folder = _local.get(app) or _local.setdefault(app, tempfile.mkdtemp(prefix="urbanflow-"))
    return folder.rstrip("/")


def stage(df: DataFrame) -> DataFrame:
    """Write a table that a plan reads several times, so that it is computed once.

    The copy goes to the shared folder, where it survives lost executors.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
