"""Record layouts and the fixed values every plan shares."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def layout(columns: str) -> T.StructType:
    """Schema from ``name type, name type``; unlike a DDL string it needs no session."""
    fields = [c.split() for c in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


@dataclass(frozen=True)
class Bound:
    """Accepted range of one measure; ``lo_open`` excludes the lower end."""

    lo: float
    hi: float
    lo_open: bool = False


@dataclass(frozen=True)
class Measure:
    """A column to average: ``mean_as = sum(source) / (unit * count(source))``.

    ``unit`` lets whole seconds be summed and reported in minutes.  ``digits``
    is for amounts stored with at most that many decimals: they are summed as
    whole numbers of their last digit, so the result is exact and does not
    depend on the order in which tasks finish or are retried.
    """

    source: str
    mean_as: str
    unit: float | None = None
    digits: int | None = None


TRIP = layout(
    "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, PULocationID int, "
    "trip_distance double, fare_amount double, total_amount double, tip_amount double"
)

COMPLAINT = layout(
    "unique_key bigint, created_date timestamp_ntz, complaint_type string, descriptor string, "
    "borough string, latitude double, longitude double"
)

WEATHER = layout(
    "time bigint, temp double, dwpt double, rhum double, prcp double, snow double, wdir double, "
    "wspd double, wpgt double, pres double, tsun double, coco double"
)

ZONE_LOOKUP_RAW = layout("LocationID string, Borough string, Zone string, service_zone string")

ZONE_FINAL = layout(
    "hour_ts timestamp_ntz, locationid int, borough string, zone string, service_zone string, trips int, "
    "avg_fare_amount double, avg_tip_amount double, avg_total_amount double, avg_trip_distance double"
)

MASTER = layout(
    "hour_ts timestamp_ntz, year int, month int, day int, hour int, borough string, trips bigint, "
    "avg_trip_duration_min double, avg_fare_amount double, avg_trip_distance double, "
    "avg_total_amount double, avg_tip_amount double, "
    "complaints_311 bigint, complaints_noise bigint, complaints_sanitation bigint, "
    "complaints_transportation bigint, "
    "temp_avg double, dewpoint_avg double, humidity_avg double, wind_avg double, wind_gust_avg double, "
    "pressure_avg double, precip_total double, snow_total double, "
    "rain int, rain_code int, rain_text string, snow int, snow_code int, snow_text string, "
    "extreme_weather int"
)

# Layout of the published, fully typed borough view.
BOROUGH_VIEW = layout(
    "year int, month int, day int, hour int, hour_ts timestamp_ntz, borough string, trips bigint, "
    "avg_fare_amount double, avg_tip_amount double, avg_total_amount double, avg_trip_distance double, "
    "avg_trip_duration_min double, temp_avg double, dewpoint_avg double, humidity_avg double, "
    "wind_avg double, wind_gust_avg double, pressure_avg double, precip_total double, snow_total double, "
    "snow_text string, snow_code int, snow int, rain int, rain_code int, rain_text string, "
    "extreme_weather int, complaints_311 bigint, complaints_noise bigint, complaints_sanitation bigint, "
    "complaints_transportation bigint, source_file string"
)

# ---------------------------------------------------------------------------
# Fixed values.  They decide results, so they are stated as they must be.
# ---------------------------------------------------------------------------

# Sanity range of a trip: more than 0 and at most 240 minutes, at most 200
# miles, fare at most 1000, total at most 2000.  The tip is not checked.
TRIP_BOUNDS = {
    "trip_duration_s": Bound(0, 240 * 60, lo_open=True),
    "trip_distance": Bound(0, 200),
    "fare_amount": Bound(0, 1000),
    "total_amount": Bound(0, 2000),
}

# Averages of the sanity-filtered zone fact.
TRIP_MEASURES = (
    Measure("trip_duration_s", "avg_trip_duration_min", unit=60.0),
    Measure("fare_amount", "avg_fare_amount"),
    Measure("trip_distance", "avg_trip_distance"),
    Measure("total_amount", "avg_total_amount"),
    Measure("tip_amount", "avg_tip_amount"),
)

# Averages of the named zone fact, which carries no duration.
NAMED_TRIP_MEASURES = (
    Measure("fare_amount", "avg_fare_amount"),
    Measure("tip_amount", "avg_tip_amount"),
    Measure("total_amount", "avg_total_amount"),
    Measure("trip_distance", "avg_trip_distance"),
)

# Keywords of each complaint class.  A complaint may fall in several classes.
COMPLAINT_CLASSES = {
    "noise": ("noise",),
    "sanitation": ("sanitation", "unsanitary", "garbage", "rodent", "pest"),
    "transportation": ("street", "traffic", "transport", "vehicle", "parking"),
}

# Weather condition codes reported as rain and as snow.
RAIN_TEXT = {
    7: "Light rain",
    8: "Rain",
    9: "Heavy rain",
    10: "Freezing rain",
    11: "Heavy freezing rain",
    12: "Sleet",
    13: "Heavy sleet",
}
SNOW_TEXT = {
    15: "Light snow",
    16: "Snow",
    17: "Heavy snow",
    18: "Snowstorm",
}
NO_RAIN = "No rain"
NO_SNOW = "No snow"

# Codes that count as extreme, and the gust speed above which any hour does.
EXTREME_CODES = (9, 11, 13, 17, 18)
EXTREME_GUST = 20

# Raw weather column -> name in the master table.
WEATHER_TO_MASTER = {
    "temp": "temp_avg",
    "dwpt": "dewpoint_avg",
    "rhum": "humidity_avg",
    "wspd": "wind_avg",
    "wpgt": "wind_gust_avg",
    "pres": "pressure_avg",
    "prcp": "precip_total",
    "snow": "snow_total",
}

# Names under which a complaint total has been delivered, most likely first.
COMPLAINT_TOTAL_NAMES = ("complaints_total", "total_complaints", "complaints")

# Borough labels that name no borough.
UNKNOWN_BOROUGHS = ("N/A", "UNKNOWN")

# Daily aggregation of the modelling features.
DAILY_FEATURES = {
    "trips": "sum",
    "temp_avg": "mean",
    "dewpoint_avg": "mean",
    "humidity_avg": "mean",
    "wind_avg": "mean",
    "pressure_avg": "mean",
    "precip_total": "sum",
    "extreme_weather": "max",
    "complaints_noise": "sum",
    "complaints_sanitation": "sum",
    "complaints_transportation": "sum",
}

# Drivers of the demand regression and of the seasonal model.
OLS_DRIVERS = (
    "temp_avg",
    "wind_avg",
    "precip_total",
    "extreme_weather",
    "complaints_noise",
    "complaints_sanitation",
    "complaints_transportation",
)
SEASONAL_DRIVERS = ("temp_avg", "precip_total", "extreme_weather", "complaints_transportation")
