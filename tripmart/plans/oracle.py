"""DuckDB twins of the registered queries (independent SQL formulations).

Each fragment is a CTE over the pre-registered test tables. Pitfalls handled
here: DuckDB ``dayofweek`` is 0 = Sunday (add 1); ``CAST(double AS INT)``
rounds, so truncation is written ``trunc``; epoch seconds are floored like
``unix_timestamp``; ``x / 0`` is guarded with ``NULLIF``; decimal literals
are cast to DOUBLE where Spark uses a double literal.
"""

from __future__ import annotations

import datetime as dt

from ..operators.audit import FKS
from ..operators.dims import DATE_END, DATE_START, LITERALS
from ..schemas import DIM_KEYS, FACTS

DBL = "CAST({} AS DOUBLE)".format


def q(s: str) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(q(v) if isinstance(v, str) else str(v) for v in r) + ")"
                     for r in rows)
    return f"(SELECT * FROM (VALUES {body}) t({', '.join(cols)}))"


def literal_dim(name: str) -> str:
    from ..schemas import DIMS
    return values(LITERALS[name], [f.name for f in DIMS[name].fields])


def date_lit(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


# ---------------------------------------------------------------- dimensions

def dim_date_sql(lo: str, hi: str) -> str:
    """dim_date between two DATE expressions (may reference a CTE ``span``)."""
    return f"""(SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS dateid,
        d AS full_date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
        CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
        CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, CAST(weekofyear(d) AS INTEGER) AS week_number,
        CASE WHEN dayofweek(d) BETWEEN 1 AND 5 THEN 1 ELSE 0 END AS is_weekday,
        CASE WHEN dayofweek(d) BETWEEN 1 AND 5 THEN 0 ELSE 1 END AS is_weekend
      FROM (SELECT CAST(unnest(generate_series(CAST({lo} AS TIMESTAMP), CAST({hi} AS TIMESTAMP),
                                               INTERVAL 1 DAY)) AS DATE) AS d FROM span))"""


def span_fixed(lo: dt.date, hi: dt.date) -> str:
    return f"span AS (SELECT {date_lit(lo)} AS lo, {date_lit(hi)} AS hi)"


SPAN_ORDERS = """span AS (SELECT make_date(CAST(year(min(o_orderdate)) AS INTEGER), 1, 1) AS lo,
    make_date(CAST(year(max(o_orderdate) + INTERVAL 2 DAY) AS INTEGER), 12, 31) AS hi FROM orders)"""

DIM_DATE = f"dim_date AS {dim_date_sql('lo', 'hi')}"

DIM_TIME = """dim_time AS (SELECT CAST(h * 100 + m AS INTEGER) AS time_id, CAST(h AS INTEGER) AS hour,
    CAST(m AS INTEGER) AS minute FROM range(24) a(h), range(60) b(m))"""

DIM_ZONE = """dim_zone AS (SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone,
    'Z' || CAST(n_regionkey AS VARCHAR) AS service_zone
    FROM nation JOIN region ON n_regionkey = r_regionkey)"""

DIM_BASE = """dim_base AS (SELECT DISTINCT 'B' || lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS license_no,
    s_name AS entity_name, n_name AS type_of_base FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


def literal_ctes() -> list[str]:
    return [f"{n} AS {literal_dim(n)}" for n in
            ("dim_payment", "dim_ratecode", "dim_vendor", "dim_license", "dim_triptype",
             "dim_flags")]


def all_dims(span: str) -> list[str]:
    return [span, DIM_DATE, DIM_TIME, DIM_ZONE, DIM_BASE, *literal_ctes()]


# ---------------------------------------------------------------- events adapter

EV = """ev AS (SELECT *, ts + to_seconds(secs) AS dropoff FROM (
    SELECT *, CASE WHEN event_id % 50 = 0 THEN CAST(-103 AS BIGINT)
                   ELSE CAST(round(value * 60) AS BIGINT) END AS secs FROM events) e)"""

_COMMON = """CAST(user_id % 2 + 1 AS BIGINT) AS VendorID,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(event_id % 7 AS DOUBLE) END AS passenger_count,
    value AS trip_distance, CAST(event_id % 7 + 1 AS DOUBLE) AS RatecodeID,
    'N' AS store_and_fwd_flag, CAST(user_id % 265 + 1 AS BIGINT) AS PULocationID,
    CAST(event_id % 265 + 1 AS BIGINT) AS DOLocationID, value AS fare_amount,
    CAST(0.5 AS DOUBLE) AS extra, CAST(0.5 AS DOUBLE) AS mta_tax,
    CASE WHEN event_id % 3 = 0 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS tip_amount,
    CAST(0.0 AS DOUBLE) AS tolls_amount, CAST(0.3 AS DOUBLE) AS improvement_surcharge,
    CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_type = 'error' THEN -value
         ELSE value + CAST(1.3 AS DOUBLE) END AS total_amount,
    CAST(2.5 AS DOUBLE) AS congestion_surcharge"""

RAW_YELLOW = f"""raw_yellow AS (SELECT ts AS tpep_pickup_datetime, dropoff AS tpep_dropoff_datetime,
    {_COMMON}, CAST(event_id % 7 AS BIGINT) AS payment_type, CAST(0.0 AS DOUBLE) AS airport_fee FROM ev)"""

RAW_GREEN = f"""raw_green AS (SELECT ts AS lpep_pickup_datetime, dropoff AS lpep_dropoff_datetime,
    {_COMMON}, CAST(NULL AS DOUBLE) AS ehail_fee, CAST(event_id % 7 AS DOUBLE) AS payment_type,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(event_id % 3 AS DOUBLE) END AS trip_type FROM ev)"""


def _flag(bit: int) -> str:
    return f"CASE WHEN (event_id % 16) & {bit} <> 0 THEN 'Y' ELSE 'N' END"


RAW_HIGHVOL = f"""raw_highvol AS (SELECT 'HV000' || CAST(event_id % 5 + 2 AS VARCHAR) AS hvfhs_license_num,
    'B' || lpad(CAST(user_id % 120 + 1 AS VARCHAR), 5, '0') AS dispatching_base_num,
    'B' || lpad(CAST(event_id % 100 + 1 AS VARCHAR), 5, '0') AS originating_base_num,
    ts AS request_datetime, ts AS on_scene_datetime, ts AS pickup_datetime, dropoff AS dropoff_datetime,
    CAST(user_id % 265 + 1 AS BIGINT) AS PULocationID, CAST(event_id % 265 + 1 AS BIGINT) AS DOLocationID,
    value AS trip_miles, secs AS trip_time, value AS base_passenger_fare, CAST(0.0 AS DOUBLE) AS tolls,
    CAST(0.25 AS DOUBLE) AS bcf, CAST(0.5 AS DOUBLE) AS sales_tax, CAST(2.75 AS DOUBLE) AS congestion_surcharge,
    CAST(0.0 AS DOUBLE) AS airport_fee,
    CASE WHEN event_id % 3 = 0 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS tip_amount,
    value AS driver_pay, {_flag(8)} AS shared_request_flag, {_flag(4)} AS shared_match_flag,
    'N' AS access_a_ride_flag, {_flag(2)} AS wav_request_flag, {_flag(1)} AS wav_match_flag FROM ev)"""


def parts(p: str, d: str) -> str:
    out = []
    for role, c in (("pickup", p), ("dropoff", d)):
        for f, fn in (("year", "year"), ("month", "month"), ("day", "day"), ("hour", "hour"),
                      ("minute", "minute")):
            out.append(f"CAST({fn}({c}) AS INTEGER) AS {role}_{f}")
    return ", ".join(out)


def minutes(p: str, d: str) -> str:
    return f"TRY_CAST(trunc((floor(epoch({d})) - floor(epoch({p}))) / 60) AS INTEGER)"


def date_id(c: str) -> str:
    return f"CAST(year({c}) * 10000 + month({c}) * 100 + day({c}) AS INTEGER)"


def time_id(c: str) -> str:
    return f"CAST(hour({c}) * 100 + minute({c}) AS INTEGER)"


def keys(p: str, d: str) -> str:
    return (f"{date_id(p)} AS pickup_date_id, {date_id(d)} AS dropoff_date_id, "
            f"{time_id(p)} AS pickup_time_id, {time_id(d)} AS dropoff_time_id")


def in_span(c: str) -> str:
    return f"CAST({c} AS DATE) BETWEEN (SELECT lo FROM span) AND (SELECT hi FROM span)"


def itrunc(c: str) -> str:
    return f"TRY_CAST(trunc({c}) AS INTEGER)"


E_TAGS = "'2024' AS data_year, '01' AS data_month"

FACT_YELLOW = f"""fact_yellow AS (SELECT VendorID, {itrunc('passenger_count')} AS passenger_count,
    trip_distance, {itrunc('RatecodeID')} AS RatecodeID, PULocationID, DOLocationID, payment_type,
    fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,
    congestion_surcharge, airport_fee,
    {minutes('tpep_pickup_datetime', 'tpep_dropoff_datetime')} AS trip_time,
    {keys('tpep_pickup_datetime', 'tpep_dropoff_datetime')}, {E_TAGS}
  FROM raw_yellow WHERE total_amount >= 0 AND {in_span('tpep_pickup_datetime')}
    AND {in_span('tpep_dropoff_datetime')})"""

GREEN_REQUIRED = ["VendorID", "RatecodeID", "PULocationID", "DOLocationID", "passenger_count",
                  "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount",
                  "tolls_amount", "improvement_surcharge", "total_amount", "payment_type",
                  "trip_type", "congestion_surcharge"]

GREEN_CAST = f"""green_cast AS (SELECT lpep_pickup_datetime, lpep_dropoff_datetime, store_and_fwd_flag,
    VendorID, {itrunc('RatecodeID')} AS RatecodeID, PULocationID, DOLocationID,
    {itrunc('passenger_count')} AS passenger_count, trip_distance, fare_amount, extra, mta_tax,
    tip_amount, tolls_amount, ehail_fee, improvement_surcharge, total_amount,
    {itrunc('payment_type')} AS payment_type, {itrunc('trip_type')} AS trip_type,
    congestion_surcharge FROM raw_green)"""

GREEN_NOT_NULL = " AND ".join(f"{c} IS NOT NULL" for c in GREEN_REQUIRED)

FACT_GREEN = f"""fact_green AS (SELECT VendorID, RatecodeID, PULocationID, DOLocationID, passenger_count,
    trip_distance, fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
    total_amount, payment_type, trip_type, congestion_surcharge,
    {minutes('lpep_pickup_datetime', 'lpep_dropoff_datetime')} AS trip_time,
    {keys('lpep_pickup_datetime', 'lpep_dropoff_datetime')}, {E_TAGS}
  FROM green_cast WHERE {GREEN_NOT_NULL} AND total_amount >= 0
    AND {in_span('lpep_pickup_datetime')} AND {in_span('lpep_dropoff_datetime')})"""

FLAG_ON = " AND ".join(f"r.{c} = f.{c}" for c in
                       ("shared_request_flag", "shared_match_flag", "wav_request_flag",
                        "wav_match_flag"))

FACT_HIGHVOL = f"""fact_highvol AS (SELECT hvfhs_license_num, dispatching_base_num, originating_base_num,
    PULocationID, DOLocationID, trip_miles, TRY_CAST(trunc(trip_time / 60) AS INTEGER) AS trip_time,
    base_passenger_fare, tolls, bcf, sales_tax, congestion_surcharge, airport_fee, tip_amount,
    driver_pay, {keys('pickup_datetime', 'dropoff_datetime')}, f.id AS flag_id, {E_TAGS}
  FROM raw_highvol r JOIN dim_flags f ON {FLAG_ON}
  WHERE {in_span('pickup_datetime')} AND {in_span('dropoff_datetime')})"""

E_SPAN = span_fixed(DATE_START, DATE_END)


def e_ctes(*extra: str, span: str = E_SPAN) -> str:
    return ",\n".join([*all_dims(span), EV, RAW_YELLOW, RAW_GREEN, RAW_HIGHVOL, GREEN_CAST,
                       *extra])


# ---------------------------------------------------------------- orders adapter

FARE = "CAST(l_extendedprice AS DECIMAL(12,2))"
TAX = "CAST(l_tax AS DECIMAL(4,2))"
DISC = "CAST(l_discount AS DECIMAL(4,2))"

ORDER_TRIPS = f"""order_trips AS (SELECT
    o_orderdate + to_minutes(l_partkey % 1440) AS pickup_datetime,
    o_orderdate + to_minutes(l_partkey % 1440 + CAST(l_quantity AS BIGINT)) AS dropoff_datetime,
    CAST(l_quantity AS DECIMAL(9,2)) AS trip_distance, {FARE} AS fare_amount,
    CAST({FARE} * {TAX} AS DECIMAL(18,2)) AS tip_amount,
    CAST({FARE} * (1 - {DISC}) * (1 + {TAX}) AS DECIMAL(18,2)) AS total_amount,
    CAST(l_suppkey % 2 + 1 AS INTEGER) AS vendor_id, CAST(l_partkey % 7 + 1 AS INTEGER) AS rate_code_id,
    CAST(c_nationkey AS INTEGER) AS pu_location_id, CAST(s_nationkey AS INTEGER) AS do_location_id,
    CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2', '3', '4')
         THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) ELSE 0 END AS payment_id,
    CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 WHEN 'N' THEN 3 END AS trip_type_id,
    strftime(o_orderdate, '%Y') AS data_year, strftime(o_orderdate, '%m') AS data_month
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey)"""

ORDER_FACT = f"""order_fact AS (SELECT trip_distance, fare_amount, tip_amount, total_amount, vendor_id,
    rate_code_id, pu_location_id, do_location_id, payment_id, trip_type_id,
    {minutes('pickup_datetime', 'dropoff_datetime')} AS trip_time,
    {keys('pickup_datetime', 'dropoff_datetime')}, data_year, data_month
  FROM order_trips WHERE {in_span('pickup_datetime')} AND {in_span('dropoff_datetime')})"""

MONEY = ("trip_distance", "fare_amount", "tip_amount", "total_amount")

DATE_ATTRS = ["full_date", "year", "quarter", "month", "day", "day_of_week", "week_number",
              "is_weekday", "is_weekend"]


def star(role: str = "pickup") -> str:
    """``star`` CTE: order_fact left-joined to the seven dashboard dimensions."""
    def rp(alias, key, pk, dk):
        if role == "same_day":
            return f"f.{pk} = {alias}.{key} AND f.{dk} = {alias}.{key}"
        return f"f.{pk if role == 'pickup' else dk} = {alias}.{key}"
    date_cols = ", ".join(f"dd.{c}" for c in DATE_ATTRS)
    return f"""star AS (SELECT f.*, {date_cols}, pay.payment_type, rc.ratecode, tt.hour, tt.minute,
    ty.trip_type, v.vendor, z.borough, z.zone, z.service_zone
  FROM order_fact f
  LEFT JOIN dim_date dd ON {rp('dd', 'dateid', 'pickup_date_id', 'dropoff_date_id')}
  LEFT JOIN dim_payment pay ON f.payment_id = pay.payment_id
  LEFT JOIN dim_ratecode rc ON f.rate_code_id = rc.ratecode_id
  LEFT JOIN dim_time tt ON {rp('tt', 'time_id', 'pickup_time_id', 'dropoff_time_id')}
  LEFT JOIN dim_triptype ty ON f.trip_type_id = ty.triptypeid
  LEFT JOIN dim_vendor v ON f.vendor_id = v.vendor_id
  LEFT JOIN dim_zone z ON {rp('z', 'location_id', 'pu_location_id', 'do_location_id')})"""


def o_ctes(*extra: str, role: str | None = None) -> str:
    ctes = [*all_dims(SPAN_ORDERS), ORDER_TRIPS, ORDER_FACT]
    if role:
        ctes.append(star(role))
    return ",\n".join([*ctes, *extra])


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def dbl_cols(cols, alias: str = "") -> str:
    """Select list where money decimals become DOUBLE."""
    pre = f"{alias}." if alias else ""
    return ", ".join(f"CAST({pre}{c} AS DOUBLE) AS {c}" if c in MONEY else f"{pre}{c}"
                     for c in cols)


def fk_audit_sql(feed: str, fact_cte: str) -> str:
    parts_ = []
    for col, dim in FKS[feed]:
        k = DIM_KEYS[dim]
        parts_.append(f"""SELECT '{col}' AS fk_column, '{dim}' AS ref_table, true AS checked,
    CAST(count({col}) AS BIGINT) AS checked_rows,
    CAST(count({col}) FILTER (WHERE CAST({col} AS VARCHAR) NOT IN
        (SELECT CAST({k} AS VARCHAR) FROM {dim} WHERE {k} IS NOT NULL)) AS BIGINT) AS orphan_rows,
    CAST(count(DISTINCT {col}) FILTER (WHERE CAST({col} AS VARCHAR) NOT IN
        (SELECT CAST({k} AS VARCHAR) FROM {dim} WHERE {k} IS NOT NULL)) AS BIGINT) AS orphan_keys
  FROM {fact_cte}""")
    return "\nUNION ALL\n".join(parts_)


def layout_select(feed: str, renames: dict) -> str:
    inv = {v: k for k, v in renames.items()}
    return ", ".join(f"{inv[c]} AS {c}" if c in inv else c for c, _ in FACTS[feed])

