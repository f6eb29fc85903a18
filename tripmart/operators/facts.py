"""Fact builders: raw monthly feed -> keyed fact rows tagged with the period.

One lazy plan per feed: read -> clean -> keys -> tag. The dimension lookups
are either arithmetic (no join) or broadcast joins, so a fact month is built
without any shuffle; nothing forces the output into a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..period import Period
from .clean import clean
from .dims import Dims
from .keys import add_flag_key, add_keys

# Raw column -> warehouse column.
WAREHOUSE_NAMES = {
    "VendorID": "vendor_id", "RatecodeID": "rate_code_id", "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id", "payment_type": "payment_id",
    "trip_type": "trip_type_id", "hvfhs_license_num": "license_number",
    "dispatching_base_num": "dispatching_baseno_id",
    "originating_base_num": "originating_baseno_id",
}


def tag_period(df: DataFrame, period: Period | None) -> DataFrame:
    """``data_year`` / ``data_month`` of the *file* (not of the trip). With
    ``period=None`` the columns must already be present (the streaming loader
    reads each month it rebuilds with its tag)."""
    if period is None:
        return df
    return df.withColumns({"data_year": F.lit(period.year), "data_month": F.lit(period.month)})


def build_fact(raw: DataFrame, feed: str, period: Period | None, dims: Dims,
               how: str = "arith") -> DataFrame:
    """Fact rows of one feed: the job's output columns (raw measure names)
    plus ``pickup_date_id``, ``dropoff_date_id``, ``pickup_time_id``,
    ``dropoff_time_id`` and the period tags."""
    if feed not in ("yellow", "green", "highvol"):
        raise ValueError(f"unknown feed {feed!r}")
    return key_fact(clean(raw, feed), feed, period, dims, how)


def key_fact(cleaned: DataFrame, feed: str, period: Period | None, dims: Dims, how: str = "arith") -> DataFrame:
    """The rest of ``build_fact`` for rows that went through ``clean``."""
    out = add_keys(cleaned, dims, how)
    if feed == "highvol":
        out = add_flag_key(out, dims)
    return tag_period(out, period)
