"""Registered queries: one Spark query per operator key, with its DuckDB twin.

Every query reads the whole test tables (or tables Spark derived from them).
At the comparison boundary decimals become doubles and dates become
``yyyy-MM-dd`` strings so both engines hand over the same Python values.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import default_period_cols, epoch_seconds, month_label, trip_minutes, trip_parts
from ..operators import audit, metrics
from ..operators.clean import INT_CASTS, clean, complete_rows, nonnegative_total
from ..operators.dims import Dims, build_dim_base, build_dim_date_over, build_dim_zone, build_dims
from ..operators.facts import WAREHOUSE_NAMES, build_fact
from ..operators.keys import add_date_keys, add_flag_key, add_time_keys
from ..operators.publish import (conform, load_month, read_dim, read_fact, read_table,
                                 to_layout, write_table)
from ..operators.star import ALL as STAR_ALL
from ..operators.star import star_view
from ..jobs import load_feed_month, read_loaded, read_lookup, read_rejects
from ..period import Period
from ..schemas import VARCHAR as O_VARCHAR
from ..session import shared_path
from ..sources.adapters import (base_lookup, event_trips, landing_manifest, order_trips_days, table,
                                zone_lookup)
from ..sources.feeds import feed_path, read_feed
from ..sources.landing import landing_status, missing_feeds
from ..streaming.month_loader import start_month_loader
from . import oracle as O
from .tables import ORDER_FACT_SCHEMA, published_orders

# Parameters of the registered queries.
E_PERIOD = Period("2024", "01")            # the events table covers January 2024
MISS_START, MISS_END = dt.date(2024, 1, 1), dt.date(2024, 1, 30)
KPI_YEAR, KPI_MONTH = 1997, "November"
RELOAD = Period("1997", "11")              # month loaded twice in load_month_idempotent

_dims_memo: dict = {}


def to_plain(df: DataFrame) -> DataFrame:
    """Decimals -> double, dates -> ``yyyy-MM-dd`` strings."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(F.col(f.name).cast("string").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def e_dims(spark: SparkSession, sf: str, start=None, end=None) -> Dims:
    key = (spark.sparkContext.applicationId, sf, start, end)
    if key not in _dims_memo:
        kw = {"start": start, "end": end} if start else {}
        _dims_memo[key] = build_dims(spark, zone=zone_lookup(spark, sf),
                                     base=base_lookup(spark, sf), **kw)
    return _dims_memo[key]


def e_fact(spark, sf, feed, how="arith") -> DataFrame:
    return build_fact(event_trips(spark, sf, feed), feed, E_PERIOD, e_dims(spark, sf), how)


def o_view(spark, sf, role="pickup", include=STAR_ALL) -> DataFrame:
    """The star view over the published order-trip fact, joined only to the
    dimensions a query names (an unused left join would still be executed)."""
    pub = published_orders(spark, sf)
    return star_view(pub.fact, pub.dims, role, include)


# ------------------------------------------------------------ events-based queries

def q_trip_datetime_parts(spark, sf):
    raw = event_trips(spark, sf, "yellow")
    p, d = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    return raw.select(p, d, *trip_parts(p, d))


def q_trip_minutes(spark, sf):
    raw = event_trips(spark, sf, "yellow")
    p, d = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    return raw.select(p, d, epoch_seconds(p).alias("unix_ts_1"), epoch_seconds(d).alias("unix_ts_2"),
                      trip_minutes(p, d).alias("trip_time"))


def q_trip_nonnegative(spark, sf):
    return nonnegative_total(event_trips(spark, sf, "yellow"))


def q_trip_complete_rows(spark, sf):
    raw = event_trips(spark, sf, "green")
    return complete_rows(raw.withColumns({c: F.col(c).try_cast("int") for c in INT_CASTS["green"]}))


def q_date_key_lookup(spark, sf):
    out = add_date_keys(clean(event_trips(spark, sf, "yellow"), "yellow"), e_dims(spark, sf), "join")
    return out.select("pickup_datetime", "dropoff_datetime", "pickup_date_id", "dropoff_date_id")


def q_time_key_lookup(spark, sf):
    out = add_time_keys(clean(event_trips(spark, sf, "yellow"), "yellow"), e_dims(spark, sf), "join")
    return out.select("pickup_datetime", "dropoff_datetime", "pickup_time_id", "dropoff_time_id")


def q_flag_key_lookup(spark, sf):
    out = add_flag_key(event_trips(spark, sf, "highvol"), e_dims(spark, sf))
    return out.select("pickup_datetime", "dropoff_datetime", "flag_id")


def q_trip_fact_yellow(spark, sf):
    return e_fact(spark, sf, "yellow")


def q_trip_fact_green(spark, sf):
    return e_fact(spark, sf, "green")


def q_trip_fact_highvol(spark, sf):
    return e_fact(spark, sf, "highvol")


def q_warehouse_layout_yellow(spark, sf):
    return to_layout(e_fact(spark, sf, "yellow"), "yellow")


def q_warehouse_layout_green(spark, sf):
    return to_layout(e_fact(spark, sf, "green"), "green")


def q_conform_yellow(spark, sf):
    good, _ = conform(to_layout(e_fact(spark, sf, "yellow"), "yellow"), "yellow")
    return to_plain(good)


def q_fact_csv_roundtrip(spark, sf):
    fact = e_fact(spark, sf, "yellow")
    path = shared_path(spark, "roundtrip", "fact_csv")
    write_table(fact, path, "csv")
    return read_table(spark, path, fact.schema, "csv")


def q_date_key_misses(spark, sf):
    dims = e_dims(spark, sf, MISS_START, MISS_END)
    return audit.key_misses(clean(event_trips(spark, sf, "yellow"), "yellow"), dims)


def q_time_key_collisions(spark, sf):
    return audit.time_key_collisions(e_dims(spark, sf), e_fact(spark, sf, "yellow"))


def _fk(feed):
    def q(spark, sf):
        return audit.fk_audit(to_layout(e_fact(spark, sf, feed), feed), e_dims(spark, sf), feed)
    return q


# ------------------------------------------------------------ orders-based queries

def q_star_view(spark, sf):
    return to_plain(o_view(spark, sf, "pickup"))


def q_star_view_same_day(spark, sf):
    return to_plain(o_view(spark, sf, "same_day"))


STAR_ROLLUP_FIELDS = ["total_amount", "fare_amount", "tip_amount", "trip_distance", "trip_time",
                      "zone", "ratecode"]


def q_star_rollup(spark, sf):
    return to_plain(metrics.star_rollup(o_view(spark, sf, include=("payment", "vendor", "zone", "ratecode")),
                                        ["payment_type", "vendor"],
                                        STAR_ROLLUP_FIELDS))


def q_fact_in_period(spark, sf):
    return to_plain(metrics.in_period(o_view(spark, sf), KPI_YEAR, KPI_MONTH))


def q_period_totals(spark, sf):
    return to_plain(metrics.period_totals(o_view(spark, sf, include=("date", "vendor")),
                                          list(metrics.MEASURES), KPI_YEAR,
                                          KPI_MONTH, by="vendor", prefilter=False))


def _yoy(measure):
    def q(spark, sf):
        return metrics.yoy(o_view(spark, sf, include=("date",)), measure, KPI_YEAR, KPI_MONTH)
    return q


def q_kpi_all(spark, sf):
    return metrics.kpi_all(o_view(spark, sf, include=("date",)), KPI_YEAR, KPI_MONTH)


def q_yoy_labels(spark, sf):
    return metrics.kpi_all(o_view(spark, sf, include=("date",)), KPI_YEAR, KPI_MONTH, labels=True)


def q_yoy_revenue_by_payment(spark, sf):
    return metrics.yoy(o_view(spark, sf, include=("date", "payment")), "revenue", KPI_YEAR,
                       KPI_MONTH, by="payment_type")


def q_yoy_fare_by_payment(spark, sf):
    return metrics.yoy(o_view(spark, sf, include=("date", "payment")), "fare", KPI_YEAR,
                       KPI_MONTH, by="payment_type")


def q_yoy_revenue_by_payment_same_day(spark, sf):
    return metrics.yoy(o_view(spark, sf, "same_day", ("date", "payment")), "revenue", KPI_YEAR, KPI_MONTH,
                       by="payment_type", role="same_day")


def q_yoy_revenue_by_payment_dropoff(spark, sf):
    return metrics.yoy(o_view(spark, sf, "dropoff", ("date", "payment")), "revenue", KPI_YEAR,
                       KPI_MONTH, by="payment_type", role="dropoff")


def q_fare_by_trip_type(spark, sf):
    return to_plain(metrics.total_by(o_view(spark, sf, include=("triptype",)), "fare", "trip_type"))


def q_fare_trip_type_rollup(spark, sf):
    return to_plain(metrics.total_by(o_view(spark, sf, include=("triptype",)), "fare", "trip_type",
                                     rollup=True))


def q_fare_share_by_trip_type(spark, sf):
    return to_plain(metrics.share_of_total(o_view(spark, sf, include=("triptype",)), "fare",
                                           "trip_type"))


def q_month_name(spark, sf):
    v = o_view(spark, sf, include=("date",))
    return v.select("data_month", month_label("data_month").alias("data_month_name"),
                    "month", month_label("month").alias("month_name"))


def q_column_profile(spark, sf):
    """Statistics of every column of the star model (fact and dimension
    attributes), as the dashboard's extract kept them."""
    return to_plain(audit.column_profile(o_view(spark, sf), approx=False))


def q_column_profile_approx(spark, sf):
    return to_plain(audit.column_profile(o_view(spark, sf), approx=True))


def _order_as_green(spark, sf):
    f = published_orders(spark, sf).fact
    missing = {c: F.lit(None).cast(t) for c, t in
               [("passenger_count", "int"), ("extra", "double"), ("mta_tax", "double"),
                ("tolls_amount", "double"), ("improvement_surcharge", "double"),
                ("congestion_surcharge", "double")]}
    return f.withColumns(missing)


def q_conform_rejects(spark, sf):
    _, rejects = conform(_order_as_green(spark, sf), "green")
    return to_plain(rejects)


def _stamp(df):
    """Number of rows and an order-free hash of them."""
    each = F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")
    return tuple(df.agg(F.count("*"), F.sum(each)).first())


def q_warehouse_month_load(spark, sf):
    """A raw month lands with every row doubled, then with amounts that no
    decimal holds (rejects only), then as it is, and is loaded each time. After
    each load both tables must be those of that landing alone, else the query
    fails; the rows are the fact after the last one."""
    root, wh = shared_path(spark, "landing", "month"), shared_path(spark, "warehouse", "month")
    raw, dims = event_trips(spark, sf, "yellow"), e_dims(spark, sf)
    for version in (raw.union(raw), raw.withColumn("total_amount", F.lit(1e12)), raw):
        write_table(version, feed_path(root, "yellow", E_PERIOD), "parquet")
        load_feed_month(spark, "yellow", E_PERIOD, root, wh, dims)
        landed = read_feed(spark, "yellow", E_PERIOD, root)
        want = conform(to_layout(build_fact(landed, "yellow", E_PERIOD, dims), "yellow"), "yellow")
        for read, rows in zip((read_loaded, read_rejects), want):
            if _stamp(read(spark, wh, "yellow")) != _stamp(rows):
                raise RuntimeError(f"{read.__name__}: not the month as it landed last")
    return to_plain(read_loaded(spark, wh, "yellow"))


def q_load_month_idempotent(spark, sf):
    fact = published_orders(spark, sf).fact
    path = shared_path(spark, "warehouse", "order_fact")
    load_month(fact, path)              # every month
    load_month(fact, path, RELOAD)      # one month again: replaces only itself
    return to_plain(read_fact(spark, path, ORDER_FACT_SCHEMA))


def q_landing_completeness(spark, sf):
    manifest = landing_manifest(spark, sf)
    months = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy").alias("year"),
        F.date_format("o_orderdate", "MM").alias("month"))
    return landing_status(manifest, expected=months)


def q_landing_missing_feeds(spark, sf):
    months = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy").alias("year"),
        F.date_format("o_orderdate", "MM").alias("month"))
    return missing_feeds(landing_manifest(spark, sf), months)


def q_default_period(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", *default_period_cols("o_orderdate"))


def q_date_key_collisions(spark, sf):
    pub = published_orders(spark, sf)
    return audit.date_key_collisions(pub.dims, pub.fact)


def q_pk_audit(spark, sf):
    return audit.pk_audit(published_orders(spark, sf).dims.named())


def q_dim_date(spark, sf):
    """The calendar of the orders' trips, derived from the tables in one plan."""
    return to_plain(build_dim_date_over(order_trips_days(spark, sf)))


def _lookup_via_csv(spark, df, kind):
    """Land a lookup derived from the tables as headered CSV, read it back
    the way the lookups arrive (CSV with header, typed by position)."""
    path = shared_path(spark, "lookups", kind)
    write_table(df, path, "csv")
    return read_lookup(spark, path, kind)


def q_dim_zone(spark, sf):
    return build_dim_zone(_lookup_via_csv(spark, zone_lookup(spark, sf), "zone"))


def q_dim_base(spark, sf):
    return build_dim_base(_lookup_via_csv(spark, base_lookup(spark, sf), "base"))


def q_dim_csv_roundtrip(spark, sf):
    path = shared_path(spark, "roundtrip", "dim_base_csv")
    write_table(published_orders(spark, sf).dims.base, path, "csv")
    return read_dim(spark, "dim_base", path, "csv")


def q_dim_parquet_roundtrip(spark, sf):
    path = shared_path(spark, "roundtrip", "dim_date_parquet")
    write_table(build_dim_date_over(order_trips_days(spark, sf)), path, "parquet")
    return to_plain(read_dim(spark, "dim_date", path, "parquet"))


def q_stream_fact_yellow(spark, sf):
    """The yellow month lands as files; a streaming query loads it."""
    root = shared_path(spark, "landing")
    raw = event_trips(spark, sf, "yellow")
    write_table(raw, f"{root}/{E_PERIOD.year}/{E_PERIOD.month}/yellow_tripdata_{E_PERIOD}", "parquet")
    table_path = shared_path(spark, "warehouse", "fact_yellow")
    q = start_month_loader(spark, "yellow", root, table_path, e_dims(spark, sf),
                           shared_path(spark, "checkpoints", "fact_yellow"))
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return read_fact(spark, table_path, e_fact(spark, sf, "yellow").schema)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "trip_datetime_parts": q_trip_datetime_parts,
        "trip_minutes": q_trip_minutes,
        "trip_nonnegative": q_trip_nonnegative,
        "trip_complete_rows": q_trip_complete_rows,
        "date_key_lookup": q_date_key_lookup,
        "time_key_lookup": q_time_key_lookup,
        "flag_key_lookup": q_flag_key_lookup,
        "trip_fact_yellow": q_trip_fact_yellow,
        "trip_fact_green": q_trip_fact_green,
        "trip_fact_highvol": q_trip_fact_highvol,
        "warehouse_layout_yellow": q_warehouse_layout_yellow,
        "warehouse_layout_green": q_warehouse_layout_green,
        "conform_yellow": q_conform_yellow,
        "fact_csv_roundtrip": q_fact_csv_roundtrip,
        "date_key_misses": q_date_key_misses,
        "time_key_collisions": q_time_key_collisions,
        "fk_audit_yellow": _fk("yellow"),
        "fk_audit_green": _fk("green"),
        "fk_audit_highvol": _fk("highvol"),
        "star_view": q_star_view,
        "star_view_same_day": q_star_view_same_day,
        "star_rollup": q_star_rollup,
        "fact_in_period": q_fact_in_period,
        "period_totals": q_period_totals,
        "yoy_revenue": _yoy("revenue"),
        "yoy_fare": _yoy("fare"),
        "yoy_tip": _yoy("tip"),
        "yoy_distance": _yoy("distance"),
        "kpi_all": q_kpi_all,
        "yoy_labels": q_yoy_labels,
        "yoy_revenue_by_payment": q_yoy_revenue_by_payment,
        "yoy_fare_by_payment": q_yoy_fare_by_payment,
        "yoy_revenue_by_payment_same_day": q_yoy_revenue_by_payment_same_day,
        "yoy_revenue_by_payment_dropoff": q_yoy_revenue_by_payment_dropoff,
        "fare_by_trip_type": q_fare_by_trip_type,
        "fare_trip_type_rollup": q_fare_trip_type_rollup,
        "fare_share_by_trip_type": q_fare_share_by_trip_type,
        "month_name": q_month_name,
        "column_profile": q_column_profile,
        "column_profile_approx": q_column_profile_approx,
        "conform_rejects": q_conform_rejects,
        "load_month_idempotent": q_load_month_idempotent,
        "warehouse_month_load": q_warehouse_month_load,
        "landing_completeness": q_landing_completeness,
        "landing_missing_feeds": q_landing_missing_feeds,
        "default_period": q_default_period,
        "date_key_collisions": q_date_key_collisions,
        "pk_audit": q_pk_audit,
        "dim_date": q_dim_date,
        "dim_zone": q_dim_zone,
        "dim_base": q_dim_base,
        "dim_csv_roundtrip": q_dim_csv_roundtrip,
        "dim_parquet_roundtrip": q_dim_parquet_roundtrip,
        "stream_fact_yellow": q_stream_fact_yellow,
    }


# ------------------------------------------------------------ SQL twins

def _sql_yoy(measures: dict, by: str | None = None, role: str = "pickup",
             labels: bool = False, having: bool = True, prefilter: bool = False) -> str:
    """Plain semantics of the YoY measures over the star. ``prefilter`` adds
    the key-range WHERE the Spark side uses; the oracle leaves it out so that
    the Spark prefilter is checked, not copied."""
    y, m = KPI_YEAR, 11
    cur = f"year = {y} AND month = {m}"
    prev = f"year = {y - 1} AND month = {m}"
    sel, aggs = [], []
    for name, col in measures.items():
        c = f"CAST(sum(CASE WHEN {cur} THEN {col} END) AS DOUBLE)"
        p = f"CAST(sum(CASE WHEN {prev} THEN {col} END) AS DOUBLE)"
        r = f"({c} - {p}) / NULLIF({p}, 0)"
        sel.append(f"{r} AS yoy_{name}")
        if labels:
            sel.append(f"format('{{:,.2f}}', ({r}) * 100) || '%' AS yoy_{name}_label")
        aggs.append(r)
    key = "dropoff_date_id" if role == "dropoff" else "pickup_date_id"
    where = ""
    if prefilter:
        where = (f"WHERE {key} BETWEEN {y * 10000 + m * 100 + 1} AND {y * 10000 + m * 100 + 31} "
                 f"OR {key} BETWEEN {(y - 1) * 10000 + m * 100 + 1} AND {(y - 1) * 10000 + m * 100 + 31}")
    group = f"GROUP BY {by}" if by else ""
    hav = f"HAVING {aggs[0]} IS NOT NULL" if by and having else ""
    cols = (f"{by}, " if by else "") + ", ".join(sel)
    return with_o(f"SELECT {cols} FROM star {where} {group} {hav}", role)


def with_o(select: str, role: str | None = "pickup", *extra: str) -> str:
    return O.with_(O.o_ctes(*extra, role=role), select)


def with_e(select: str, *extra: str, span: str = O.E_SPAN) -> str:
    return O.with_(O.e_ctes(*extra, span=span), select)


YP, YD = "tpep_pickup_datetime", "tpep_dropoff_datetime"
STAR_COLS = ([f.name for f in ORDER_FACT_SCHEMA.fields] + O.DATE_ATTRS +
             ["payment_type", "ratecode", "hour", "minute", "trip_type", "vendor", "borough",
              "zone", "service_zone"])


def _star_select(where: str = "") -> str:
    cols = ", ".join("CAST(full_date AS VARCHAR) AS full_date" if c == "full_date" else
                     (f"CAST({c} AS DOUBLE) AS {c}" if c in O.MONEY else c) for c in STAR_COLS)
    return f"SELECT {cols} FROM star {where}"


def _layout_cte(feed: str, fact: str) -> str:
    return f"layout_{feed} AS (SELECT {O.layout_select(feed, WAREHOUSE_NAMES)} FROM {fact})"


def _conform_sql() -> str:
    from ..schemas import FACTS
    checks, outs = [], []
    for c, t in FACTS["yellow"]:
        if isinstance(t, T.DecimalType):
            conv = f"TRY_CAST({c} AS DECIMAL({t.precision},{t.scale}))"
            outs.append(f"CAST({conv} AS DOUBLE) AS {c}")
        elif isinstance(t, T.IntegerType):
            conv = f"TRY_CAST(trunc({c}) AS INTEGER)"
            outs.append(f"{conv} AS {c}")
        else:
            n = O_VARCHAR.get(c)
            conv = f"CASE WHEN strlen({c}) <= {n} THEN {c} END" if n else c
            outs.append(f"{conv} AS {c}")
        checks.append(f"NOT ({c} IS NOT NULL AND {conv} IS NULL)")
    return with_e(f"SELECT {', '.join(outs)} FROM layout_yellow WHERE {' AND '.join(checks)}",
                  O.FACT_YELLOW, _layout_cte("yellow", "fact_yellow"))


def _rejects_sql() -> str:
    from ..schemas import FACTS
    src = {"passenger_count": "CAST(NULL AS INTEGER)", "extra": "CAST(NULL AS DOUBLE)",
           "mta_tax": "CAST(NULL AS DOUBLE)", "tolls_amount": "CAST(NULL AS DOUBLE)",
           "improvement_surcharge": "CAST(NULL AS DOUBLE)",
           "congestion_surcharge": "CAST(NULL AS DOUBLE)"}
    inner = ", ".join(f"{src[c]} AS {c}" if c in src else c for c, _ in FACTS["green"])
    fails, outs = [], []
    for c, t in FACTS["green"]:
        if isinstance(t, T.DecimalType):
            conv = f"TRY_CAST({c} AS DECIMAL({t.precision},{t.scale}))"
        elif isinstance(t, T.IntegerType):
            conv = f"TRY_CAST({c} AS INTEGER)"
        else:
            n = O_VARCHAR.get(c)
            conv = f"CASE WHEN strlen({c}) <= {n} THEN {c} END" if n else c
        fails.append((c, f"({c} IS NOT NULL AND {conv} IS NULL)"))
        outs.append(f"CAST({c} AS DOUBLE) AS {c}" if c in O.MONEY else c)
    reason = "concat_ws(',', " + ", ".join(f"CASE WHEN {f} THEN '{c}' END" for c, f in fails) + ")"
    return with_o(f"SELECT {', '.join(outs)}, {reason} AS reject_reason FROM green_in "
                  f"WHERE {' OR '.join(f for _, f in fails)}", None,
                  f"green_in AS (SELECT {inner} FROM order_fact)")


def _profile_sql() -> str:
    aggs = ["CAST(count(*) AS BIGINT) AS n_rows"]
    for c in STAR_COLS:
        if c in O.MONEY:
            conv = "CAST({} AS DOUBLE)".format
        elif c == "full_date":
            conv = "CAST({} AS VARCHAR)".format
        else:
            conv = "{}".format
        aggs += [f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS {c}__nulls",
                 f"{conv(f'min({c})')} AS {c}__min", f"{conv(f'max({c})')} AS {c}__max"]
    return with_o(f"SELECT {', '.join(aggs)} FROM star")


def _misses_sql() -> str:
    cleaned = (f"cleaned AS (SELECT {YP} AS p, {YD} AS d FROM raw_yellow WHERE total_amount >= 0)")
    parts_ = []
    for role, c in (("pickup", "p"), ("dropoff", "d")):
        parts_.append(f"SELECT '{role}' AS role, 'date' AS kind, CAST(count(*) AS BIGINT) AS missing_rows "
                      f"FROM cleaned WHERE {c} IS NULL OR NOT ({O.in_span(c)})")
        parts_.append(f"SELECT '{role}' AS role, 'time' AS kind, CAST(count(*) AS BIGINT) AS missing_rows "
                      f"FROM cleaned WHERE {c} IS NULL")
    return with_e(" UNION ALL ".join(parts_), cleaned, span=O.span_fixed(MISS_START, MISS_END))


def _collisions_sql(kind: str) -> str:
    if kind == "time":
        legacy = "CAST(hour AS VARCHAR) || CAST(minute AS VARCHAR)"
        dim, key, trips, tkey, build = "dim_time", "time_id", "fact_yellow", "pickup_time_id", with_e
        extra = [O.FACT_YELLOW]
    else:
        legacy = "CAST(CAST(year AS VARCHAR) || CAST(month AS VARCHAR) || CAST(day AS VARCHAR) AS INTEGER)"
        dim, key, trips, tkey, build = "dim_date", "dateid", "order_fact", "pickup_date_id", None
        extra = []
    ctes = [f"lg AS (SELECT {key} AS k, {legacy} AS legacy_id FROM {dim})",
            "cl AS (SELECT legacy_id FROM lg GROUP BY legacy_id HAVING count(*) > 1)",
            f"tr AS (SELECT {tkey} AS k, count(*) AS t FROM {trips} GROUP BY {tkey})"]
    sel = ("SELECT lg.legacy_id, CAST(count(*) AS BIGINT) AS n_keys, "
           "CAST(coalesce(sum(t), 0) AS BIGINT) AS n_trips FROM lg JOIN cl ON lg.legacy_id = cl.legacy_id "
           "LEFT JOIN tr ON tr.k = lg.k GROUP BY lg.legacy_id")
    if build:
        return build(sel, *extra, *ctes)
    return with_o(sel, None, *ctes)


def _pk_sql() -> str:
    from ..schemas import DIM_KEYS
    parts_ = []
    for name in ("dim_date", "dim_time", "dim_flags", "dim_payment", "dim_ratecode", "dim_vendor",
                 "dim_zone", "dim_license", "dim_triptype", "dim_base"):
        k = DIM_KEYS[name]
        parts_.append(
            f"SELECT '{name}' AS table_name, '{k}' AS key_column, CAST(sum(n) AS BIGINT) AS n_rows, "
            f"CAST(coalesce(sum(CASE WHEN {k} IS NULL THEN n END), 0) AS BIGINT) AS null_keys, "
            f"CAST(count(*) FILTER (WHERE {k} IS NOT NULL AND n > 1) AS BIGINT) AS duplicate_keys "
            f"FROM (SELECT {k}, count(*) AS n FROM {name} GROUP BY {k})")
    return with_o(" UNION ALL ".join(parts_), None)


DIM_DATE_PLAIN = ("SELECT dateid, CAST(full_date AS VARCHAR) AS full_date, year, quarter, month, day, "
                  "day_of_week, week_number, is_weekday, is_weekend FROM dim_date")

_FACT_PLAIN = O.dbl_cols([f.name for f in ORDER_FACT_SCHEMA.fields])


def oracle_sql() -> dict[str, str]:
    parts_sel = O.parts(YP, YD)
    m = metrics.MEASURES
    money = {k: v for k, v in m.items()}
    return {
        "trip_datetime_parts": with_e(f"SELECT {YP}, {YD}, {parts_sel} FROM raw_yellow"),
        "trip_minutes": with_e(
            f"SELECT {YP}, {YD}, CAST(floor(epoch({YP})) AS BIGINT) AS unix_ts_1, "
            f"CAST(floor(epoch({YD})) AS BIGINT) AS unix_ts_2, {O.minutes(YP, YD)} AS trip_time "
            f"FROM raw_yellow"),
        "trip_nonnegative": with_e("SELECT * FROM raw_yellow WHERE total_amount >= 0"),
        "trip_complete_rows": with_e(f"SELECT * FROM green_cast WHERE {O.GREEN_NOT_NULL}"),
        "date_key_lookup": with_e(
            f"SELECT {YP} AS pickup_datetime, {YD} AS dropoff_datetime, {O.date_id(YP)} AS pickup_date_id, "
            f"{O.date_id(YD)} AS dropoff_date_id FROM raw_yellow WHERE total_amount >= 0 "
            f"AND {O.in_span(YP)} AND {O.in_span(YD)}"),
        "time_key_lookup": with_e(
            f"SELECT {YP} AS pickup_datetime, {YD} AS dropoff_datetime, {O.time_id(YP)} AS pickup_time_id, "
            f"{O.time_id(YD)} AS dropoff_time_id FROM raw_yellow WHERE total_amount >= 0 "
            f"AND {YP} IS NOT NULL AND {YD} IS NOT NULL"),
        "flag_key_lookup": with_e(
            f"SELECT r.pickup_datetime, r.dropoff_datetime, f.id AS flag_id FROM raw_highvol r "
            f"JOIN dim_flags f ON {O.FLAG_ON}"),
        "trip_fact_yellow": with_e("SELECT * FROM fact_yellow", O.FACT_YELLOW),
        "trip_fact_green": with_e("SELECT * FROM fact_green", O.FACT_GREEN),
        "trip_fact_highvol": with_e("SELECT * FROM fact_highvol", O.FACT_HIGHVOL),
        "warehouse_layout_yellow": with_e("SELECT * FROM layout_yellow", O.FACT_YELLOW,
                                          _layout_cte("yellow", "fact_yellow")),
        "warehouse_layout_green": with_e("SELECT * FROM layout_green", O.FACT_GREEN,
                                         _layout_cte("green", "fact_green")),
        "conform_yellow": _conform_sql(),
        "fact_csv_roundtrip": with_e("SELECT * FROM fact_yellow", O.FACT_YELLOW),
        "date_key_misses": _misses_sql(),
        "time_key_collisions": _collisions_sql("time"),
        "fk_audit_yellow": with_e(O.fk_audit_sql("yellow", "layout_yellow"), O.FACT_YELLOW,
                                  _layout_cte("yellow", "fact_yellow")),
        "fk_audit_green": with_e(O.fk_audit_sql("green", "layout_green"), O.FACT_GREEN,
                                 _layout_cte("green", "fact_green")),
        "fk_audit_highvol": with_e(O.fk_audit_sql("highvol", "layout_highvol"), O.FACT_HIGHVOL,
                                   _layout_cte("highvol", "fact_highvol")),
        "star_view": with_o(_star_select(), "pickup"),
        "star_view_same_day": with_o(_star_select(), "same_day"),
        "star_rollup": with_o(
            "SELECT payment_type, vendor, "
            + ", ".join(f"CAST(count({c}) AS BIGINT) AS count_{c}" if c in ("zone", "ratecode") else
                        (f"CAST(sum({c}) AS BIGINT) AS sum_{c}" if c == "trip_time" else
                         f"CAST(sum({c}) AS DOUBLE) AS sum_{c}") for c in STAR_ROLLUP_FIELDS)
            + " FROM star GROUP BY payment_type, vendor"),
        "fact_in_period": with_o(_star_select(f"WHERE year = {KPI_YEAR} AND month = 11")),
        "period_totals": with_o(
            "SELECT vendor, " + ", ".join(
                f"CAST(sum(CASE WHEN year = {KPI_YEAR - k} AND month = 11 THEN {col} END) AS DOUBLE) "
                f"AS {pre}_{name}" for name, col in money.items()
                for k, pre in ((0, "cur"), (1, "prev"))) + " FROM star GROUP BY vendor"),
        "yoy_revenue": _sql_yoy({"revenue": m["revenue"]}),
        "yoy_fare": _sql_yoy({"fare": m["fare"]}),
        "yoy_tip": _sql_yoy({"tip": m["tip"]}),
        "yoy_distance": _sql_yoy({"distance": m["distance"]}),
        "kpi_all": _sql_yoy(money),
        "yoy_labels": _sql_yoy(money, labels=True),
        "yoy_revenue_by_payment": _sql_yoy({"revenue": m["revenue"]}, by="payment_type"),
        "yoy_fare_by_payment": _sql_yoy({"fare": m["fare"]}, by="payment_type"),
        "yoy_revenue_by_payment_same_day": _sql_yoy({"revenue": m["revenue"]}, by="payment_type",
                                                    role="same_day"),
        "yoy_revenue_by_payment_dropoff": _sql_yoy({"revenue": m["revenue"]}, by="payment_type",
                                                   role="dropoff"),
        "fare_by_trip_type": with_o(
            "SELECT trip_type, CAST(sum(fare_amount) AS DOUBLE) AS total_fare FROM star GROUP BY trip_type"),
        "fare_trip_type_rollup": with_o(
            "SELECT trip_type, CAST(sum(fare_amount) AS DOUBLE) AS total_fare, "
            "CAST(grouping(trip_type) AS INTEGER) AS grouping_id FROM star GROUP BY ROLLUP (trip_type)"),
        "fare_share_by_trip_type": with_o(
            "SELECT trip_type, CAST(t AS DOUBLE) AS total_fare, "
            "CAST(t AS DOUBLE) / NULLIF(CAST(sum(t) OVER () AS DOUBLE), 0) AS share_fare "
            "FROM (SELECT trip_type, sum(fare_amount) AS t FROM star GROUP BY trip_type)"),
        "month_name": with_o(
            "SELECT data_month, " + _month_case("TRY_CAST(data_month AS INTEGER)") + " AS data_month_name, "
            "month, " + _month_case("month") + " AS month_name FROM star"),
        "column_profile": _profile_sql(),
        "conform_rejects": _rejects_sql(),
        "load_month_idempotent": with_o(f"SELECT {_FACT_PLAIN} FROM order_fact", None),
        "warehouse_month_load": _conform_sql(),
        "landing_completeness": with_o(_landing_sql(), None),
        "landing_missing_feeds": _missing_sql(),
        "default_period": O.with_(
            "p AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) - INTERVAL 3 MONTH AS d FROM orders)",
            "SELECT o_orderkey, strftime(d, '%Y') AS period_year, strftime(d, '%m') AS period_month FROM p"),
        "date_key_collisions": _collisions_sql("date"),
        "pk_audit": _pk_sql(),
        "dim_date": with_o(DIM_DATE_PLAIN, None),
        "dim_zone": with_o("SELECT * FROM dim_zone", None),
        "dim_base": with_o("SELECT * FROM dim_base", None),
        "dim_csv_roundtrip": with_o("SELECT * FROM dim_base", None),
        "dim_parquet_roundtrip": with_o(DIM_DATE_PLAIN, None),
        "stream_fact_yellow": with_e("SELECT * FROM fact_yellow", O.FACT_YELLOW),
    }


def _month_case(expr: str) -> str:
    from ..period import MONTH_NAMES
    whens = " ".join(f"WHEN {i + 1} THEN '{n}'" for i, n in enumerate(MONTH_NAMES))
    return f"CASE {expr} {whens} END"


def _landing_sql() -> str:
    return """SELECT e.year, e.month, CAST(coalesce(l.n, 0) AS INTEGER) AS feeds_landed,
    CASE WHEN coalesce(l.n, 0) = 2 THEN 'success' ELSE 'fail' END AS result
  FROM (SELECT DISTINCT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month FROM orders) e
  LEFT JOIN (SELECT year, month, count(DISTINCT feed) AS n FROM (
      SELECT DISTINCT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month,
             CASE WHEN l_linestatus = 'F' THEN 'yellow' ELSE 'green' END AS feed
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey) m
    WHERE NOT (feed = 'green' AND CAST(month AS INTEGER) % 5 = 0)
    GROUP BY year, month) l ON e.year = l.year AND e.month = l.month"""


def _missing_sql() -> str:
    return """WITH months AS (SELECT DISTINCT strftime(o_orderdate, '%Y') AS year,
        strftime(o_orderdate, '%m') AS month FROM orders),
  wanted AS (SELECT year, month, unnest(['yellow', 'green']) AS feed FROM months),
  landed AS (SELECT DISTINCT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month,
        CASE WHEN l_linestatus = 'F' THEN 'yellow' ELSE 'green' END AS feed
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT w.year, w.month, w.feed FROM wanted w
WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.year = w.year AND l.month = w.month
                  AND l.feed = w.feed AND NOT (l.feed = 'green' AND CAST(l.month AS INTEGER) % 5 = 0))"""
