"""Per-feed cleaning: calendar parts, trip minutes, casts, drops and filters.

The order of the steps is part of the semantics: in the green feed the casts
run before the any-null rule, so a cast that yields null removes the row;
the non-negative total filter is last in both feeds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import seconds_to_minutes, trip_minutes, trip_parts
from ..schemas import TIMESTAMPS

# Column names of the monthly files.
# Green: a row is dropped when any of these is null (after the casts).
GREEN_REQUIRED = [
    "VendorID", "RatecodeID", "PULocationID", "DOLocationID", "passenger_count",
    "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "payment_type", "trip_type",
    "congestion_surcharge",
]

# Columns removed from the raw feed once the parts and minutes exist.
DROPPED = {
    "yellow": ["store_and_fwd_flag"],
    "green": ["store_and_fwd_flag", "ehail_fee"],
    "highvol": ["request_datetime", "on_scene_datetime", "access_a_ride_flag"],
}
INT_CASTS = {
    "yellow": ["passenger_count", "RatecodeID"],
    "green": ["passenger_count", "RatecodeID", "payment_type", "trip_type"],
    "highvol": [],
}


def with_trip_parts(df: DataFrame, pickup: str, dropoff: str) -> DataFrame:
    return df.select("*", *trip_parts(pickup, dropoff))


def with_trip_minutes(df: DataFrame, pickup: str, dropoff: str) -> DataFrame:
    return df.withColumn("trip_time", trip_minutes(pickup, dropoff))


def nonnegative_total(df: DataFrame) -> DataFrame:
    """Keep ``total_amount >= 0``; a null total is dropped as well."""
    return df.filter(F.col("total_amount") >= 0)


def complete_rows(df: DataFrame, required=GREEN_REQUIRED) -> DataFrame:
    """Drop a row when any required column is null."""
    return df.na.drop(how="any", subset=list(required))


def clean(df: DataFrame, feed: str) -> DataFrame:
    """Raw feed -> cleaned trips with ``pickup_*`` / ``dropoff_*`` parts,
    integer ``trip_time`` minutes, the pickup/dropoff timestamps kept for the
    key step (it drops them), other dropped columns removed."""
    pickup, dropoff = TIMESTAMPS[feed]
    out = with_trip_parts(df, pickup, dropoff)
    if feed == "highvol":
        out = out.withColumn("trip_time", seconds_to_minutes("trip_time"))
    else:
        out = with_trip_minutes(out, pickup, dropoff)
    out = out.drop(*DROPPED[feed])
    if INT_CASTS[feed]:
        out = out.withColumns({c: F.col(c).try_cast("int") for c in INT_CASTS[feed]})
    if feed == "green":
        out = complete_rows(out)
    if feed != "highvol":
        out = nonnegative_total(out)
    return out.withColumnsRenamed({pickup: "pickup_datetime", dropoff: "dropoff_datetime"})
