"""Decoded hourly weather."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import bucket, epoch_nanos_to_time, with_time_parts
from ..functions.weather import code_in, code_text, is_extreme
from ..schemas import NO_RAIN, NO_SNOW, RAIN_TEXT, SNOW_TEXT, WEATHER_TO_MASTER


def decode_weather(
    raw: DataFrame,
    tz: str | None = None,
    rain: Mapping[int, str] = RAIN_TEXT,
    snow: Mapping[int, str] = SNOW_TEXT,
) -> DataFrame:
    """Raw rows with their time decoded and their condition code explained.

    Hours are UTC.  Trips and complaints carry local wall-clock hours; give
    their zone as ``tz`` to line the weather up with them.
    """
    timed = raw.withColumnRenamed("time", "time_ns").withColumns(
        {"time_us": F.expr("time_ns div 1000"), "ts": epoch_nanos_to_time("time_ns", tz)}
    )
    timed = with_time_parts(timed.withColumn("hour_ts", bucket("ts")))
    measures = [c for c in raw.columns if c != "time"]
    return timed.select(
        "time_ns", "time_us", "ts", "hour_ts", "year", "month", "day", "hour",
        *measures,
        code_in("coco", rain).alias("rain_code"),
        code_text("coco", rain, NO_RAIN).alias("rain_text"),
        code_in("coco", snow).alias("snow_code"),
        code_text("coco", snow, NO_SNOW).alias("snow_text"),
        is_extreme("coco", "wpgt").alias("extreme_weather"),
    )


def weather_for_master(decoded: DataFrame) -> DataFrame:
    """Decoded weather under the master table's names, with rain and snow flags."""
    named = decoded.withColumnsRenamed(WEATHER_TO_MASTER)
    flags = {
        "rain": F.when(F.col("rain_code") > 0, 1).otherwise(0),
        "snow": F.when(F.col("snow_code") > 0, 1).otherwise(0),
    }
    return named.withColumns(flags)
