"""The hour x borough master table and what is published from it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import label
from ..functions.times import bucket
from ..operators.joins import one_row_per_key
from ..operators.predicates import exclude_values
from ..operators.project import (
    apply_if_present,
    fill_zero,
    keep_present,
    prefix_cols,
    presentation_view,
    rename_first,
)
from ..operators.rollup import classify_counts
from ..sources.writers import save_bucketed
from ..schemas import BOROUGH_VIEW, COMPLAINT_CLASSES, COMPLAINT_TOTAL_NAMES, MASTER, UNKNOWN_BOROUGHS, ZONE_FINAL

WEATHER_COLUMNS = tuple(MASTER.fieldNames()[MASTER.fieldNames().index("temp_avg") :])
COMPLAINT_COLUMNS = ("complaints_311", *[f"complaints_{c}" for c in COMPLAINT_CLASSES])


def normalise_complaints(c311: DataFrame) -> DataFrame:
    """Complaint facts with their total under the master's name.

    Raw complaints (those with a ``unique_key``) are aggregated first, by
    upper-cased keywords.  Aggregated ones are added up again, as labels that
    differ in case or spaces only are one borough.
    """
    c311 = apply_if_present(c311, "borough", label)
    if "unique_key" not in c311.columns:
        c311 = rename_first(c311, COMPLAINT_TOTAL_NAMES, "complaints_311")
        keys = [c for c in ("hour_ts", "borough") if c in c311.columns]
        counts = [c for c in c311.columns if c in COMPLAINT_COLUMNS]
        same = [F.first(c, ignorenulls=True).alias(c) for c in c311.columns if c not in (*keys, *counts)]
        return c311.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts], *same).select(*c311.columns)
    if "hour_ts" not in c311.columns:
        c311 = rename_first(c311, ("created_ts", "created_date"), "created_ts")
        c311 = c311.withColumn("hour_ts", bucket("created_ts"))
    return classify_counts(
        c311, ["hour_ts", "borough"], "complaint_type", total_as="complaints_311", by="upper"
    )


def build_master(
    taxi: DataFrame, c311: DataFrame, weather: DataFrame, duplicate_weather: str = "error"
) -> DataFrame:
    """Trips, with the complaints and the weather of their hour.

    Every trip row is kept once: hours without complaints get zero complaints,
    hours without weather get NULL weather.  Two weather rows for one hour
    would repeat trips and fail the job; ``duplicate_weather="keep"`` lets
    them.  Columns an input lacks are left out of the result.
    """
    taxi = apply_if_present(taxi, "borough", label)
    c311 = prefix_cols(normalise_complaints(c311), "c311")
    weather = keep_present(prefix_cols(weather, "weather"), ["hour_ts", *WEATHER_COLUMNS])
    weather = one_row_per_key(weather, ["hour_ts"], duplicate_weather)
    joined = taxi.join(c311, ["hour_ts", "borough"], "left").join(weather, ["hour_ts"], "left")
    return keep_present(fill_zero(joined, COMPLAINT_COLUMNS), MASTER.fieldNames())


def colocate(
    taxi: DataFrame, c311: DataFrame, weather: DataFrame, prefix: str, buckets: int, path: str | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three inputs of the master as tables bucketed by hour, named ``prefix`` and their role.

    ``build_master`` then shuffles none of them, whatever their size: the
    labels are cleaned, the complaints added up, the weather checked and all
    joined bucket by bucket.  The join on hour and borough reuses buckets of the
    hour alone where the session sets
    ``spark.sql.requireAllClusterKeysForCoPartition`` to false; hours hold
    about equal numbers of rows, so no bucket stands out.
    """
    inputs = {"taxi": taxi, "c311": c311, "weather": weather}
    saved = [
        save_bucketed(df, f"{prefix}_{role}", ["hour_ts"], buckets, f"{path}/{role}" if path else None) for role, df in inputs.items()
    ]
    return saved[0], saved[1], saved[2]


def finalise(table: DataFrame, unknown: Iterable[str] = UNKNOWN_BOROUGHS) -> DataFrame:
    """Rows that name a borough."""
    return exclude_values(table, "borough", unknown)


def borough_view(final: DataFrame) -> DataFrame:
    """Typed view for reports; values that do not convert are NULL."""
    return presentation_view(final, BOROUGH_VIEW)


def zone_view(named: DataFrame) -> DataFrame:
    """Typed view of the zone-level table; values that do not convert are NULL."""
    return presentation_view(named, ZONE_FINAL)


def flattened_borough_view(flat: DataFrame, prefix: str = "v_") -> DataFrame:
    """Columns of a flattened object table under their plain names, untyped.

    Partition and lineage columns keep their own values where an object key
    repeats them.
    """
    plain = [f for f in BOROUGH_VIEW.fieldNames() if f in flat.columns or f"{prefix}{f}" in flat.columns]
    return flat.select(*[F.col(f if f in flat.columns else f"{prefix}{f}").alias(f) for f in plain])
