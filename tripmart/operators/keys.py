"""Role-playing key lookups: pickup/dropoff date and time keys, flag key.

Two equivalent forms:

* ``how="join"`` — inner equi-joins of the trip parts against the
  broadcast dimension, as in the original job;
* ``how="arith"`` (default) — the padded keys are computed from the parts and
  dimension membership becomes a range check on ``[date_start, date_end]``
  (every clock minute exists in ``dim_time``). No join, no broadcast, and the
  range predicate on the raw timestamps reaches the Parquet scan. Valid for a
  date dimension produced by ``build_dim_date``; tests assert both forms give
  the same rows. A dimension read from storage that fails the contiguity
  check (``dims_from_tables``) always takes the join form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import date_key_from_parts, in_date_range
from ..plans.joins import join_dim
from .dims import Dims

ROLES = ("pickup", "dropoff")
FLAG_COLS = ["shared_request_flag", "shared_match_flag", "wav_request_flag", "wav_match_flag"]


def _parts(role: str, kind: str) -> list[str]:
    names = ("year", "month", "day") if kind == "date" else ("hour", "minute")
    return [f"{role}_{n}" for n in names]


def add_date_keys(df: DataFrame, dims: Dims, how: str = "arith") -> DataFrame:
    """Add ``pickup_date_id`` / ``dropoff_date_id``; trips whose date has no
    dimension row are dropped (inner-join semantics)."""
    if how == "arith" and dims.date_contiguous:
        keep = (in_date_range("pickup_datetime", dims.date_start, dims.date_end)
                & in_date_range("dropoff_datetime", dims.date_start, dims.date_end))
        return df.filter(keep).withColumns({
            f"{r}_date_id": date_key_from_parts(*_parts(r, "date")) for r in ROLES})
    for r in ROLES:
        y, m, d = _parts(r, "date")
        dim = dims.date.select(F.col("dateid").alias(f"{r}_date_id"), F.col("year").alias(y),
                               F.col("month").alias(m), F.col("day").alias(d))
        df = join_dim(df, dim, [y, m, d], "inner", "date" in dims.small)
    return df


def add_time_keys(df: DataFrame, dims: Dims, how: str = "arith") -> DataFrame:
    """Add ``pickup_time_id`` / ``dropoff_time_id`` (``hhmm``)."""
    if how == "arith" and dims.time_complete:
        keep = F.col("pickup_hour").isNotNull() & F.col("dropoff_hour").isNotNull()
        return df.filter(keep).withColumns({
            f"{r}_time_id": (F.col(f"{r}_hour") * 100 + F.col(f"{r}_minute")).cast("int")
            for r in ROLES})
    for r in ROLES:
        h, m = _parts(r, "time")
        dim = dims.time.select(F.col("time_id").alias(f"{r}_time_id"),
                               F.col("hour").alias(h), F.col("minute").alias(m))
        df = join_dim(df, dim, [h, m], "inner", "time" in dims.small)
    return df


def add_keys(df: DataFrame, dims: Dims, how: str = "arith") -> DataFrame:
    """Date and time keys, then the parts and raw timestamps are dropped."""
    out = add_time_keys(add_date_keys(df, dims, how), dims, how)
    parts = [f"{r}_{n}" for r in ROLES for n in ("year", "month", "day", "hour", "minute")]
    return out.drop(*parts, "pickup_datetime", "dropoff_datetime")


def add_flag_key(df: DataFrame, dims: Dims) -> DataFrame:
    """Junk-dimension lookup: the four Y/N flags -> ``flag_id`` (inner)."""
    dim = dims.flags.select(F.col("id").alias("flag_id"), *FLAG_COLS)
    return join_dim(df, dim, FLAG_COLS, "inner", "flags" in dims.small).drop(*FLAG_COLS)
