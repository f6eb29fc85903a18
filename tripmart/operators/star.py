"""Star view: a fact left-joined to the dimensions a query names.

Role-playing dimensions (date, time, zone) join on one role:

* ``pickup`` (default) or ``dropoff`` — the key of that role;
* ``same_day`` — the dashboard model's conjunctive relation: the dimension
  row must equal *both* the pickup and the dropoff key, so a trip crossing
  midnight (or zones, or minutes) gets null attributes.

All joins are left joins (unmatched fact rows survive with null attributes,
e.g. the null payment bucket). Bounded dimensions are broadcast, so the fact
is scanned once and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import join_dim
from .dims import Dims

ROLE_PLAYING = {
    "date": ("dateid", "pickup_date_id", "dropoff_date_id",
             ["full_date", "year", "quarter", "month", "day", "day_of_week", "week_number",
              "is_weekday", "is_weekend"]),
    "time": ("time_id", "pickup_time_id", "dropoff_time_id", ["hour", "minute"]),
    "zone": ("location_id", "pu_location_id", "do_location_id",
             ["borough", "zone", "service_zone"]),
}
SIMPLE = {
    "payment": ("payment_id", "payment_id", ["payment_type"]),
    "ratecode": ("ratecode_id", "rate_code_id", ["ratecode"]),
    "vendor": ("vendor_id", "vendor_id", ["vendor"]),
    "triptype": ("triptypeid", "trip_type_id", ["trip_type"]),
}
ALL = ("date", "payment", "ratecode", "time", "triptype", "vendor", "zone")
ROLES = ("pickup", "dropoff", "same_day")


def star_view(fact: DataFrame, dims: Dims, role: str = "pickup",
              include=ALL, names: dict | None = None) -> DataFrame:
    """Fact columns plus the attributes of every dimension in ``include``.

    ``names`` renames dimension attributes (e.g. ``{"zone": "pickup_zone"}``),
    so that two roles can sit in one view: the fact's key columns stay, and a
    second ``star_view`` call with the other role adds the other names."""
    if role not in ROLES:
        raise ValueError(f"role must be one of {ROLES}")
    names = names or {}
    out = fact
    for name in include:
        dim = dims.table(name)
        if dim is None:
            continue
        small = name in dims.small
        if name in ROLE_PLAYING:
            key, pk, dk, attrs = ROLE_PLAYING[name]
            k = f"__{name}_key"
            d = dim.select(F.col(key).alias(k), *[F.col(a).alias(names.get(a, a)) for a in attrs])
            if role == "same_day":
                on: Column = (out[pk] == d[k]) & (out[dk] == d[k])
            else:
                on = out[pk if role == "pickup" else dk] == d[k]
            out = join_dim(out, d, on, "left", small).drop(k)
        else:
            key, fk, attrs = SIMPLE[name]
            k = f"__{name}_key"
            d = dim.select(F.col(key).alias(k), *[F.col(a).alias(names.get(a, a)) for a in attrs])
            out = join_dim(out, d, out[fk] == d[k], "left", small).drop(k)
    return out
