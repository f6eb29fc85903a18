"""Declared schemas: raw monthly feeds, the ten dimensions, the three facts.

Raw feeds are read with these schemas instead of footer inference; the
dimension and fact layouts follow the warehouse DDL (names unified to
``pu_location_id`` and ``pickup_time_id`` / ``dropoff_time_id`` for every
feed).
"""

from __future__ import annotations

from pyspark.sql import types as T

I, L, D, S = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
TS = T.TimestampNTZType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW_YELLOW = _struct(
    ("VendorID", L), ("tpep_pickup_datetime", TS), ("tpep_dropoff_datetime", TS),
    ("passenger_count", D), ("trip_distance", D), ("RatecodeID", D),
    ("store_and_fwd_flag", S), ("PULocationID", L), ("DOLocationID", L),
    ("payment_type", L), ("fare_amount", D), ("extra", D), ("mta_tax", D),
    ("tip_amount", D), ("tolls_amount", D), ("improvement_surcharge", D),
    ("total_amount", D), ("congestion_surcharge", D), ("airport_fee", D),
)

RAW_GREEN = _struct(
    ("VendorID", L), ("lpep_pickup_datetime", TS), ("lpep_dropoff_datetime", TS),
    ("store_and_fwd_flag", S), ("RatecodeID", D), ("PULocationID", L),
    ("DOLocationID", L), ("passenger_count", D), ("trip_distance", D),
    ("fare_amount", D), ("extra", D), ("mta_tax", D), ("tip_amount", D),
    ("tolls_amount", D), ("ehail_fee", D), ("improvement_surcharge", D),
    ("total_amount", D), ("payment_type", D), ("trip_type", D),
    ("congestion_surcharge", D),
)

RAW_HIGHVOL = _struct(
    ("hvfhs_license_num", S), ("dispatching_base_num", S), ("originating_base_num", S),
    ("request_datetime", TS), ("on_scene_datetime", TS), ("pickup_datetime", TS),
    ("dropoff_datetime", TS), ("PULocationID", L), ("DOLocationID", L),
    ("trip_miles", D), ("trip_time", L), ("base_passenger_fare", D), ("tolls", D),
    ("bcf", D), ("sales_tax", D), ("congestion_surcharge", D), ("airport_fee", D),
    ("tip_amount", D), ("driver_pay", D), ("shared_request_flag", S),
    ("shared_match_flag", S), ("access_a_ride_flag", S), ("wav_request_flag", S),
    ("wav_match_flag", S),
)

RAW = {"yellow": RAW_YELLOW, "green": RAW_GREEN, "highvol": RAW_HIGHVOL}

# Pickup / dropoff timestamp column of each raw feed.
TIMESTAMPS = {
    "yellow": ("tpep_pickup_datetime", "tpep_dropoff_datetime"),
    "green": ("lpep_pickup_datetime", "lpep_dropoff_datetime"),
    "highvol": ("pickup_datetime", "dropoff_datetime"),
}

DIM_DATE = _struct(
    ("dateid", I), ("full_date", T.DateType()), ("year", I), ("quarter", I),
    ("month", I), ("day", I), ("day_of_week", I), ("week_number", I),
    ("is_weekday", I), ("is_weekend", I),
)
DIM_TIME = _struct(("time_id", I), ("hour", I), ("minute", I))
DIM_FLAGS = _struct(("id", I), ("shared_request_flag", S), ("shared_match_flag", S),
                    ("wav_request_flag", S), ("wav_match_flag", S))
DIM_PAYMENT = _struct(("payment_id", I), ("payment_type", S))
DIM_RATECODE = _struct(("ratecode_id", I), ("ratecode", S))
DIM_VENDOR = _struct(("vendor_id", I), ("vendor", S))
DIM_ZONE = _struct(("location_id", I), ("borough", S), ("zone", S), ("service_zone", S))
DIM_LICENSE = _struct(("license_number", S), ("license_holder", S))
DIM_TRIPTYPE = _struct(("triptypeid", I), ("trip_type", S))
DIM_BASE = _struct(("license_no", S), ("entity_name", S), ("type_of_base", S))

DIMS = {
    "dim_date": DIM_DATE, "dim_time": DIM_TIME, "dim_flags": DIM_FLAGS,
    "dim_payment": DIM_PAYMENT, "dim_ratecode": DIM_RATECODE, "dim_vendor": DIM_VENDOR,
    "dim_zone": DIM_ZONE, "dim_license": DIM_LICENSE, "dim_triptype": DIM_TRIPTYPE,
    "dim_base": DIM_BASE,
}

# Primary key of each dimension (warehouse DDL).
DIM_KEYS = {
    "dim_date": "dateid", "dim_time": "time_id", "dim_flags": "id",
    "dim_payment": "payment_id", "dim_ratecode": "ratecode_id", "dim_vendor": "vendor_id",
    "dim_zone": "location_id", "dim_license": "license_number",
    "dim_triptype": "triptypeid", "dim_base": "license_no",
}


def dec(p: int, s: int = 2) -> T.DecimalType:
    return T.DecimalType(p, s)


# Warehouse fact layouts: (column, type, max string length or None).
FACT_YELLOW = [
    ("passenger_count", I), ("trip_distance", dec(9)), ("fare_amount", dec(7)),
    ("extra", dec(7)), ("mta_tax", dec(7)), ("tip_amount", dec(7)),
    ("tolls_amount", dec(7)), ("improvement_surcharge", dec(7)),
    ("congestion_surcharge", dec(7)), ("total_amount", dec(7)), ("airport_fee", dec(7)),
    ("trip_time", I), ("pu_location_id", I), ("do_location_id", I), ("vendor_id", I),
    ("rate_code_id", I), ("payment_id", I), ("pickup_date_id", I), ("dropoff_date_id", I),
    ("pickup_time_id", I), ("dropoff_time_id", I), ("data_year", S), ("data_month", S),
]
FACT_GREEN = [
    ("passenger_count", I), ("trip_distance", dec(8)), ("fare_amount", dec(7)),
    ("extra", dec(7)), ("mta_tax", dec(7)), ("tip_amount", dec(7)),
    ("tolls_amount", dec(7)), ("improvement_surcharge", dec(7)), ("total_amount", dec(7)),
    ("congestion_surcharge", dec(7)), ("trip_time", I), ("trip_type_id", I),
    ("pickup_date_id", I), ("vendor_id", I), ("rate_code_id", I), ("pu_location_id", I),
    ("payment_id", I), ("do_location_id", I), ("pickup_time_id", I),
    ("dropoff_time_id", I), ("dropoff_date_id", I), ("data_year", S), ("data_month", S),
]
FACT_HIGHVOL = [
    ("trip_miles", dec(8)), ("trip_time", I), ("base_passenger_fare", dec(8)),
    ("tolls", dec(8)), ("bcf", dec(8)), ("sales_tax", dec(8)),
    ("congestion_surcharge", dec(8)), ("airport_fee", dec(8)), ("tip_amount", dec(8)),
    ("driver_pay", dec(8)), ("flag_id", I), ("pu_location_id", I), ("do_location_id", I),
    ("license_number", S), ("pickup_date_id", I), ("dropoff_date_id", I),
    ("dispatching_baseno_id", S), ("originating_baseno_id", S),
    ("pickup_time_id", I), ("dropoff_time_id", I), ("data_year", S), ("data_month", S),
]
FACTS = {"yellow": FACT_YELLOW, "green": FACT_GREEN, "highvol": FACT_HIGHVOL}

# varchar widths of the warehouse (string columns not listed are unbounded).
VARCHAR = {
    "data_year": 4, "data_month": 2, "license_number": 20,
    "dispatching_baseno_id": 10, "originating_baseno_id": 10,
}


def fact_schema(feed: str) -> T.StructType:
    return _struct(*FACTS[feed])
