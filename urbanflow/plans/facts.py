"""Trip and complaint facts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import label
from ..functions.times import bucket, seconds_between, with_time_parts
from ..operators.joins import attach_borough, attach_zone_names
from ..operators.predicates import in_month, not_blank, within_bounds
from ..operators.rollup import classify_counts, hourly_rollup, weighted_rollup
from ..schemas import COMPLAINT_CLASSES, NAMED_TRIP_MEASURES, TRIP_BOUNDS, TRIP_MEASURES, Bound, Measure

PICKUP, DROPOFF, ZONE = "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID"


def with_duration(trips: DataFrame) -> DataFrame:
    """Add the trip's length in whole seconds."""
    return trips.withColumn("trip_duration_s", seconds_between(PICKUP, DROPOFF))


def zone_facts(
    trips: DataFrame,
    month: tuple[int, int] | None = None,
    bounds: Mapping[str, Bound] | None = TRIP_BOUNDS,
    measures: Iterable[Measure] = TRIP_MEASURES,
    grain: str = "hour",
) -> DataFrame:
    """Hour x zone trip counts and means of sane trips.

    ``bounds=None`` keeps every trip with a known zone.  Filters come first and
    on stored columns, so the scan applies the month range, the zone check and
    the amount ranges.
    """
    rows = trips
    if month:
        rows = rows.filter(in_month(PICKUP, *month))
    rows = within_bounds(with_duration(rows), bounds or {}, not_null=[ZONE])
    facts = with_time_parts(hourly_rollup(rows, PICKUP, [ZONE], measures, grain))
    means = [m.mean_as for m in measures]
    return facts.select("hour_ts", "year", "month", "day", "hour", ZONE, "trips", *means)


def named_zone_facts(
    trips: DataFrame,
    lookup: DataFrame,
    in_scope: Column | None = None,
    measures: Iterable[Measure] = NAMED_TRIP_MEASURES,
) -> DataFrame:
    """Hour x zone trip counts and means with zone names, of all trips with time and zone.

    ``in_scope`` keeps the trips of the wanted months.  Names are joined to the
    aggregated facts; zones the lookup lacks keep NULL names.
    """
    rows = trips.filter(F.col(PICKUP).isNotNull() & F.col(ZONE).isNotNull())
    if in_scope is not None:
        rows = rows.filter(in_scope)
    facts = attach_zone_names(hourly_rollup(rows, PICKUP, [ZONE], measures), lookup)
    means = [m.mean_as for m in measures]
    return facts.select("hour_ts", "locationid", "borough", "zone", "service_zone", "trips", *means)


def borough_facts(
    zones: DataFrame,
    lookup: DataFrame,
    means: Sequence[str] = tuple(m.mean_as for m in TRIP_MEASURES),
    strict: bool = False,
) -> DataFrame:
    """Hour x borough trip counts and trip-weighted means.

    Grouping is by (hour_ts, borough) alone, the key of the later joins, so
    those reuse its partitioning; the time parts are derived afterwards.
    """
    joined = attach_borough(zones, lookup)
    facts = with_time_parts(weighted_rollup(joined, ["hour_ts", "borough"], means, "trips", strict))
    return facts.select("hour_ts", "year", "month", "day", "hour", "borough", "trips", *means)


def complaint_facts(
    complaints: DataFrame,
    classes: Mapping[str, Iterable[str]] = COMPLAINT_CLASSES,
    by: str = "regex",
) -> DataFrame:
    """Hour x borough complaint counts, total and by keyword class."""
    rows = complaints.filter(F.col("created_date").isNotNull()).withColumn("borough", label("borough"))
    rows = not_blank(rows, "borough").withColumn("hour_ts", bucket("created_date"))
    counts = classify_counts(rows, ["hour_ts", "borough"], "complaint_type", classes, by=by)
    named = [f"complaints_{c}" for c in classes]
    return with_time_parts(counts).select(
        "hour_ts", "borough", "year", "month", "day", "hour", "complaints_total", *named
    )
