"""Registered queries of the warehouse side: month loads from landed files,
dimension imports, audits, profiles and summaries kept by month, the landing
gate over files, and the dashboard in one scan; each with its DuckDB twin.

Queries that land files write them below the shared folder first, from the test
tables; the operators then see files only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..jobs import load_feed_month, read_loaded, read_rejects
from ..operators import audit, dim_import, metrics, profile, summary
from ..operators.dims import build_dims
from ..operators.publish import export_month_csv, load_month, read_table, write_table
from ..period import Period
from ..schemas import FACTS, VARCHAR
from ..session import shared_path
from ..sources.adapters import base_lookup, event_trips, table, zone_lookup
from ..sources.feeds import feed_path, read_feed
from ..sources.landing import landing_status, merge_manifest
from ..streaming.month_loader import start_warehouse_loader
from . import oracle as O
from . import registry as R
from .tables import published_orders

MONTHS = [Period("2024", m) for m in ("01", "02", "03", "04")]


# ------------------------------------------------------------ month loads

def _jan_dims(spark, sf):
    """A calendar of January 2024 alone: trips that end in February miss it."""
    return R.e_dims(spark, sf, R.E_PERIOD.first_day(), R.E_PERIOD.last_day())


def _raw(spark, sf, feed):
    """The feed's month; of green, every trip of vendor 1 has a fare a million
    times as high, which mostly fits no warehouse column."""
    raw = event_trips(spark, sf, feed)
    if feed == "green":
        fare = F.col("fare_amount")
        raw = raw.withColumn("fare_amount", F.when(F.col("VendorID") == 1, fare * 1e6).otherwise(fare))
    return raw


def _loaded(spark, sf, feed) -> tuple[str, dict]:
    root, wh = shared_path(spark, "landing", feed), shared_path(spark, "warehouse", feed)
    write_table(_raw(spark, sf, feed), feed_path(root, feed, R.E_PERIOD), "parquet")
    return wh, load_feed_month(spark, feed, R.E_PERIOD, root, wh, _jan_dims(spark, sf))


def q_month_load_green(spark, sf):
    return R.to_plain(read_loaded(spark, _loaded(spark, sf, "green")[0], "green"))


def q_month_load_highvol(spark, sf):
    return R.to_plain(read_loaded(spark, _loaded(spark, sf, "highvol")[0], "highvol"))


def q_month_rejects_green(spark, sf):
    return R.to_plain(read_rejects(spark, _loaded(spark, sf, "green")[0], "green"))


def q_stream_warehouse_green(spark, sf):
    """The streaming loader runs the whole month job. Yellow lands alone (the
    month waits), then green twice over (it loads), then green as it is, under the
    same path; between the runs the query stops and starts again from its
    checkpoint. Only the month is listed."""
    root, wh = shared_path(spark, "landing", "stream"), shared_path(spark, "warehouse", "stream")
    ckpt, dims, green = shared_path(spark, "checkpoints", "stream"), _jan_dims(spark, sf), _raw(spark, sf, "green")
    for feed, rows in (("yellow", _raw(spark, sf, "yellow")), ("green", green.union(green)), ("green", green)):
        write_table(rows, feed_path(root, feed, R.E_PERIOD), "parquet")
        q = start_warehouse_loader(spark, root, wh, ckpt, dims, watch=lambda: [R.E_PERIOD])
        q.awaitTermination()
        if q.exception():
            raise RuntimeError(str(q.exception()))
    return R.to_plain(read_loaded(spark, wh, "green"))


COUNTS = ["read", "loaded", "rejected", "dropped", "pickup_date_misses", "pickup_time_misses",
          "dropoff_date_misses", "dropoff_time_misses"]


def q_month_load_counts(spark, sf):
    """What the loads of the three feeds counted themselves."""
    rows = [[r["feed"], *[r[c] for c in COUNTS]] for r in (_loaded(spark, sf, f)[1] for f in FACTS)]
    return spark.createDataFrame(rows, ", ".join(["feed string", *[f"`{c}` long" for c in COUNTS]]))


def q_fact_csv_month(spark, sf):
    """The loaded month exported under ``Fact/<feed>/<yyyy>/<MM>`` and read back."""
    fact = read_loaded(spark, _loaded(spark, sf, "highvol")[0], "highvol")
    path = export_month_csv(fact, shared_path(spark, "export"), "highvol", R.E_PERIOD)
    return R.to_plain(read_table(spark, path, fact.schema, "csv"))


# ------------------------------------------------------------ dimension imports

def _bad_lines(rows: DataFrame, name: str, path: str) -> None:
    """Add a file of the lines in ``rows`` (one column) to a CSV folder."""
    header = rows.sparkSession.createDataFrame([(0, ",".join(dim_import.positions(name)))], "k int, value string")
    (rows.select(F.lit(1).alias("k"), F.col(rows.columns[0]).alias("value")).union(header).coalesce(1)
     .sortWithinPartitions("k").select("value").write.mode("append").text(path))


def _import(spark, sf, name) -> tuple[DataFrame, DataFrame]:
    path = shared_path(spark, "imports", name)
    line = lambda *cols: F.concat_ws(",", *cols).alias("value")
    dims = build_dims(spark)
    if name == "dim_base":
        rows = base_lookup(spark, sf).distinct()
        number = F.substring("license_no", 2, 5).cast("int")
        wide = rows.where(number % 7 == 0).select(line(F.concat("license_no", F.lit("-WIDE")), "entity_name", "type_of_base"))
        more = rows.where(number % 11 == 0).select(line("license_no", "entity_name", "type_of_base", F.lit("more")))
        none = rows.where(number % 13 == 0).select(line(F.lit(""), "entity_name", "type_of_base"))
        bad = wide.union(more).union(none)
    elif name == "dim_zone":
        rows = zone_lookup(spark, sf).withColumn("zone", F.concat("zone", F.lit(', "'), "borough", F.lit('"')))
        # Eleven letters, 22 bytes.
        bad = rows.select(line("location_id", F.lit("é" * 11), F.lit("wide"), "service_zone"))
    elif name == "dim_date":
        days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("full_date")).distinct()
        rows = published_orders(spark, sf).dims.date.join(days, "full_date", "left_semi")
        order = dim_import.positions(name)
        bad = rows.where("day = 1").select(line(*[F.concat(F.lit("d"), c) if c == "dateid" else F.col(c) for c in order]))
    elif name == "dim_time":
        seen = table(spark, sf, "events").select(F.hour("ts").alias("hour"), F.minute("ts").alias("minute")).distinct()
        rows = dims.time.join(seen, ["hour", "minute"], "left_semi")
        bad = rows.where("minute = 0").select(line("hour", "minute"))
    else:
        keys = ["shared_request_flag", "shared_match_flag", "wav_request_flag", "wav_match_flag"]
        rows = dims.flags.join(event_trips(spark, sf, "highvol").select(*keys).distinct(), keys, "left_semi")
        bad = rows.select(line("id", F.lit("Yes"), *keys[1:]))
    dim_import.export_dim(rows, name, path)
    _bad_lines(bad, name, path)
    return dim_import.import_dim(spark, name, path)


def _imported(name):
    def q(spark, sf):
        return R.to_plain(_import(spark, sf, name)[0])
    return q


def q_dim_import_rejects(spark, sf):
    out = None
    for name in ("dim_base", "dim_zone", "dim_date", "dim_time", "dim_flags"):
        bad = _import(spark, sf, name)[1]
        out = bad if out is None else out.union(bad)
    return out


# ------------------------------------------------------------ kept by month

def _green_fact(spark, sf) -> DataFrame:
    return R._order_as_green(spark, sf).select(*[c for c, _ in FACTS["green"]])


def _reloaded(spark, fact: DataFrame, keep, name: str) -> DataFrame:
    """What ``keep`` (fact -> rows by file month) stores after all months, one of
    them doubled, and that month again as it is."""
    path = shared_path(spark, "kept", name)
    month = fact.where((F.col("data_year") == R.RELOAD.year) & (F.col("data_month") == R.RELOAD.month))
    rows = keep(fact)
    load_month(rows, path)
    load_month(keep(month.union(month)), path, R.RELOAD)
    load_month(keep(month), path, R.RELOAD)
    return spark.read.schema(rows.schema).parquet(path)


def q_star_profile(spark, sf):
    """Every field of the star model (48: the green fact and its dimensions) with
    rows, nulls, extremes, exact distinct values, and whether the estimate from
    the months' merged sketches is within its bound. The fact is scanned once."""
    dims = published_orders(spark, sf).dims
    counts = profile.value_counts(_green_fact(spark, sf), dims, table="fact_green")
    path = shared_path(spark, "kept", "month_profile")
    months = profile.month_profile(counts)
    load_month(months, path)
    merged = profile.merge_months(spark.read.schema(months.schema).parquet(path))
    out = merged.join(profile.exact_distinct(counts), "column_name", "left").withColumn(
        "distinct_values", F.coalesce("distinct_values", F.lit(0).cast("long")))
    ok = F.abs(F.col("estimate") - F.col("distinct_values")) <= 1 + profile.estimate_bound() * F.col("distinct_values")
    return out.withColumn("estimate_ok", ok).drop("estimate")


def q_star_profile_reload(spark, sf):
    """Rows, nulls and extremes per field after one month's profile was replaced."""
    dims = published_orders(spark, sf).dims
    keep = lambda fact: profile.month_profile(profile.value_counts(fact, dims, table="fact_green"))
    merged = profile.merge_months(_reloaded(spark, _green_fact(spark, sf), keep, "month_profile"))
    return merged.drop("estimate")


def q_fk_audit_months(spark, sf):
    """The foreign-key audit summed from the months' own key counts."""
    keep = lambda fact: audit.fk_key_counts(fact, "green", ("data_year", "data_month"))
    counts = _reloaded(spark, _green_fact(spark, sf), keep, "fk_counts")
    return audit.fk_audit_of(counts, published_orders(spark, sf).dims, "green")


def q_kpi_from_summary(spark, sf):
    """The KPIs by payment type from the summary that month loads keep."""
    pub = published_orders(spark, sf)
    kept = _reloaded(spark, pub.fact, summary.summarize, "summary")
    return metrics.yoy(summary.summary_view(kept, pub.dims), list(metrics.MEASURES), R.KPI_YEAR, R.KPI_MONTH,
                       by="payment_type")


def q_dashboard(spark, sf):
    view = R.o_view(spark, sf, include=("date", "payment", "triptype"))
    return R.to_plain(metrics.dashboard(view, R.KPI_YEAR, R.KPI_MONTH))


# ------------------------------------------------------------ landed files

def _third(day):
    """The month as which a day of January lands here."""
    return F.when(day <= 10, "01").when(day <= 20, "02").otherwise("03")


def q_landing_gate_files(spark, sf):
    """The gate over listed files: thirds of the events land as months 1 to 3,
    green of month 2 and all of month 4 are missing, green of month 3 comes after
    the first listing; the second lists that month alone."""
    root, kept = shared_path(spark, "landing", "gate"), shared_path(spark, "kept", "manifest")

    def land(feed, period):
        day = F.dayofmonth({"yellow": "tpep_pickup_datetime", "green": "lpep_pickup_datetime"}[feed])
        rows = event_trips(spark, sf, feed).where(_third(day) == period.month)
        if not rows.isEmpty():
            write_table(rows, feed_path(root, feed, period), "parquet")

    for p in MONTHS[:3]:
        land("yellow", p)
    land("green", MONTHS[0])
    merge_manifest(spark, kept, root, MONTHS)
    land("green", MONTHS[2])
    manifest = merge_manifest(spark, kept, root, [MONTHS[2]])
    expected = spark.createDataFrame([(p.year, p.month) for p in MONTHS], "year string, month string")
    return landing_status(manifest, expected)


def q_feed_months_drift(spark, sf):
    """Three months of yellow, the second with another physical schema, read as
    one feed: what each month's file holds."""
    root, raw = shared_path(spark, "landing", "drift"), event_trips(spark, sf, "yellow")
    for p in MONTHS[:3]:
        rows = raw.where(_third(F.dayofmonth("tpep_pickup_datetime")) == p.month)
        if p.month == "02":
            rows = (rows.withColumn("passenger_count", F.col("passenger_count").cast("bigint"))
                    .withColumnRenamed("airport_fee", "Airport_fee").drop("congestion_surcharge"))
        write_table(rows, feed_path(root, "yellow", p), "parquet")
    return read_feed(spark, "yellow", MONTHS[:3], root, tag=True).groupBy("data_year", "data_month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("passenger_count").alias("passengers"),
        F.count("congestion_surcharge").alias("n_congestion"), F.count("airport_fee").alias("n_airport"),
        F.min("tpep_pickup_datetime").alias("first_pickup"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "month_load_green": q_month_load_green,
        "month_load_highvol": q_month_load_highvol,
        "month_rejects_green": q_month_rejects_green,
        "month_load_counts": q_month_load_counts,
        "stream_warehouse_green": q_stream_warehouse_green,
        "fact_csv_month": q_fact_csv_month,
        **{n.replace("dim_", "dim_import_"): _imported(n)
           for n in ("dim_base", "dim_zone", "dim_date", "dim_time", "dim_flags")},
        "dim_import_rejects": q_dim_import_rejects,
        "star_profile": q_star_profile,
        "star_profile_reload": q_star_profile_reload,
        "fk_audit_months": q_fk_audit_months,
        "kpi_from_summary": q_kpi_from_summary,
        "dashboard": q_dashboard,
        "landing_gate_files": q_landing_gate_files,
        "feed_months_drift": q_feed_months_drift,
    }


# ------------------------------------------------------------ SQL twins

JAN = O.span_fixed(R.E_PERIOD.first_day(), R.E_PERIOD.last_day())
FACT_SQL = {"yellow": O.FACT_YELLOW, "green": O.FACT_GREEN, "highvol": O.FACT_HIGHVOL}


def with_jan(select: str, *extra: str) -> str:
    """``select`` over the events adapter, green with the fares of ``_raw``."""
    sql = R.with_e(select, *extra, span=JAN)
    sql = sql.replace("raw_green AS (", "green_as_was AS (", 1)
    fare = "CASE WHEN VendorID = 1 THEN fare_amount * 1e6 ELSE fare_amount END AS fare_amount"
    return sql.replace("green_cast AS (", f"raw_green AS (SELECT * REPLACE ({fare}) FROM green_as_was),\ngreen_cast AS (", 1)


def _checks(feed: str) -> list[tuple[str, str, str]]:
    """(column, conformed expression, reject condition) of a feed's layout."""
    out = []
    for c, t in FACTS[feed]:
        if isinstance(t, T.DecimalType):
            conv = f"TRY_CAST({c} AS DECIMAL({t.precision},{t.scale}))"
        elif isinstance(t, T.IntegerType):
            conv = f"TRY_CAST(trunc({c}) AS INTEGER)"
        else:
            conv = f"CASE WHEN strlen({c}) <= {VARCHAR[c]} THEN {c} END" if c in VARCHAR else c
        out.append((c, f"CAST({conv} AS DOUBLE)" if isinstance(t, T.DecimalType) else conv,
                    f"({c} IS NOT NULL AND {conv} IS NULL)"))
    return out


def _layout(feed: str) -> list[str]:
    return [FACT_SQL[feed], R._layout_cte(feed, f"fact_{feed}")]


def _loaded_sql(feed: str) -> str:
    checks = _checks(feed)
    return with_jan(f"SELECT {', '.join(f'{v} AS {c}' for c, v, _ in checks)} FROM layout_{feed} "
                    f"WHERE NOT ({' OR '.join(b for _, _, b in checks)})", *_layout(feed))


def _rejects_sql(feed: str) -> str:
    checks = _checks(feed)
    reason = "concat_ws(',', " + ", ".join(f"CASE WHEN {b} THEN '{c}' END" for c, _, b in checks) + ")"
    return with_jan(f"SELECT {', '.join(c for c, _, _ in checks)}, {reason} AS reject_reason FROM layout_{feed} "
                    f"WHERE {' OR '.join(b for _, _, b in checks)}", *_layout(feed))


def _counts_sql() -> str:
    cleaned = {"yellow": f"SELECT {R.YP} AS p, {R.YD} AS d FROM raw_yellow WHERE total_amount >= 0",
               "green": "SELECT lpep_pickup_datetime AS p, lpep_dropoff_datetime AS d FROM green_cast "
                        f"WHERE {O.GREEN_NOT_NULL} AND total_amount >= 0",
               "highvol": "SELECT pickup_datetime AS p, dropoff_datetime AS d FROM raw_highvol"}
    out = []
    for feed, rows in cleaned.items():
        bad = " OR ".join(b for _, _, b in _checks(feed))
        num = {"read": f"(SELECT count(*) FROM raw_{feed})",
               "loaded": f"(SELECT count(*) FROM layout_{feed} WHERE NOT ({bad}))",
               "rejected": f"(SELECT count(*) FROM layout_{feed} WHERE {bad})",
               "dropped": f"(SELECT count(*) FROM raw_{feed}) - (SELECT count(*) FROM layout_{feed})"}
        for role, c in (("pickup", "p"), ("dropoff", "d")):
            num[f"{role}_date_misses"] = f"(SELECT count(*) FROM ({rows}) WHERE {c} IS NULL OR NOT ({O.in_span(c)}))"
            num[f"{role}_time_misses"] = f"(SELECT count(*) FROM ({rows}) WHERE {c} IS NULL)"
        out.append(f"SELECT '{feed}' AS feed, " + ", ".join(f"{v} AS \"{k}\"" for k, v in num.items()))
    return with_jan(" UNION ALL ".join(out), *[x for f in FACTS for x in _layout(f)])


def _import_sql(name: str) -> str:
    plain = {
        "dim_base": "SELECT * FROM dim_base",
        "dim_zone": """SELECT location_id, borough, zone || ', "' || borough || '"' AS zone, service_zone FROM dim_zone""",
        "dim_date": R.DIM_DATE_PLAIN + " WHERE full_date IN (SELECT CAST(o_orderdate AS DATE) FROM orders)",
        "dim_time": "SELECT * FROM dim_time WHERE (hour, minute) IN (SELECT (hour(ts), minute(ts)) FROM events)",
        "dim_flags": f"SELECT * FROM dim_flags f WHERE EXISTS (SELECT 1 FROM raw_highvol r WHERE {O.FLAG_ON})",
    }[name]
    return R.with_e(plain) if name in ("dim_time", "dim_flags") else R.with_o(plain, None)


def _import_rejects_sql() -> str:
    number = "CAST(substr(license_no, 2, 5) AS INTEGER)"
    day = ", ".join(f"CAST({c} AS VARCHAR)" for c in dim_import.positions("dim_date")[:-1])
    parts = [
        f"SELECT 'dim_base' AS table_name, license_no || '-WIDE,' || entity_name || ',' || type_of_base AS line, "
        f"'license_no wider than 10' AS reason FROM dim_base WHERE {number} % 7 = 0",
        f"SELECT 'dim_base', license_no || ',' || entity_name || ',' || type_of_base || ',more', 'malformed line' "
        f"FROM dim_base WHERE {number} % 11 = 0",
        f"SELECT 'dim_base', ',' || entity_name || ',' || type_of_base, 'license_no empty' FROM dim_base "
        f"WHERE {number} % 13 = 0",
        f"SELECT 'dim_zone', location_id || ',{'é' * 11},wide,' || service_zone, 'borough wider than 20' FROM dim_zone",
        f"SELECT 'dim_date', concat_ws(',', {day}, 'd' || dateid), 'dateid not int' FROM dim_date "
        "WHERE day = 1 AND full_date IN (SELECT CAST(o_orderdate AS DATE) FROM orders)",
        "SELECT 'dim_time', hour || ',' || minute, 'malformed line' FROM dim_time WHERE minute = 0 AND "
        "(hour, minute) IN (SELECT (hour(ts), minute(ts)) FROM events)",
        "SELECT 'dim_flags', id || ',Yes,' || shared_match_flag || ',' || wav_request_flag || ',' || wav_match_flag, "
        f"'shared_request_flag wider than 1' FROM dim_flags f WHERE EXISTS (SELECT 1 FROM raw_highvol r WHERE {O.FLAG_ON})",
    ]
    return R.with_o(" UNION ALL ".join(parts), None, O.EV, O.RAW_HIGHVOL)


def _profile_sql(full: bool) -> str:
    from ..operators.star import ALL, ROLE_PLAYING, SIMPLE
    from ..schemas import DIM_KEYS, DIMS
    missing = {"passenger_count", "extra", "mta_tax", "tolls_amount", "improvement_surcharge", "congestion_surcharge"}

    def one(name, c, t, rows):
        text = isinstance(t, (T.StringType, T.DateType))
        num, txt = ("NULL::DOUBLE", f"CAST({{}}({c}) AS VARCHAR)") if text else (f"CAST({{}}({c}) AS DOUBLE)", "NULL::VARCHAR")
        more = f", count(DISTINCT {c}) AS distinct_values, true AS estimate_ok" if full else ""
        return (f"SELECT '{name}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS null_rows, "
                + ", ".join(f"{x.format(f) if '{}' in x else x} AS {f}_{k}" for k, x in (("num", num), ("txt", txt))
                            for f in ("min", "max")) + f"{more} FROM {rows}")
    out = [one(f"fact_green.{c}", "NULL::DOUBLE" if c in missing else c, t, "order_fact") for c, t in FACTS["green"]]
    for n in ALL:
        key, fk = ROLE_PLAYING[n][:2] if n in ROLE_PLAYING else SIMPLE[n][:2]
        out += [one(f"dim_{n}.{f.name}", f"d.{f.name}", f.dataType,
                    f"order_fact f LEFT JOIN dim_{n} d ON f.{fk} = d.{DIM_KEYS[f'dim_{n}']}") for f in DIMS[f"dim_{n}"].fields]
    return R.with_o(" UNION ALL ".join(out), None)


def _green_in() -> str:
    return "green_in AS (SELECT * FROM order_fact)"


def _dashboard_sql() -> str:
    y, m = R.KPI_YEAR, 11

    def yoy(c):
        cur, prev = (f"CAST(sum(CASE WHEN year = {y - k} AND month = {m} THEN {c} END) AS DOUBLE)" for k in (0, 1))
        return f"({cur} - {prev}) / NULLIF({prev}, 0)"
    rev, fare, tip, dist = (yoy(metrics.MEASURES[k]) for k in ("revenue", "fare", "tip", "distance"))
    total = "CAST(sum(fare_amount) AS DOUBLE)"
    null = "NULL::DOUBLE"
    cols = lambda *v: ", ".join(f"{x} AS {c}" for x, c in zip(v, (
        "tile", "member", "yoy_revenue", "yoy_fare", "yoy_tip", "yoy_distance", "total_fare", "share_fare")))
    return R.with_o(
        f"SELECT {cols(chr(39) + 'kpi' + chr(39), 'NULL::VARCHAR', rev, fare, tip, dist, total, null)} FROM star UNION ALL "
        f"SELECT {cols(chr(39) + 'payment_type' + chr(39), 'payment_type', rev, fare, null, null, null, null)} FROM star "
        f"GROUP BY payment_type HAVING {rev} IS NOT NULL OR {fare} IS NOT NULL UNION ALL "
        f"SELECT {cols(chr(39) + 'trip_type' + chr(39), 'trip_type', null, null, null, null, total, f'{total} / (SELECT {total} FROM star)')} "
        "FROM star GROUP BY trip_type")


_THIRD = "CASE WHEN day(ts) <= 10 THEN '01' WHEN day(ts) <= 20 THEN '02' ELSE '03' END"


def _gate_sql() -> str:
    return f"""WITH landed AS (SELECT DISTINCT {_THIRD} AS month, feed FROM events, (VALUES ('yellow'), ('green')) f(feed)),
n AS (SELECT m.month, CAST(count(l.feed) AS INTEGER) AS feeds_landed FROM (VALUES ('01'), ('02'), ('03'), ('04')) m(month)
  LEFT JOIN landed l ON l.month = m.month AND NOT (l.month = '02' AND l.feed = 'green') GROUP BY m.month)
SELECT '2024' AS year, month, feeds_landed, CASE WHEN feeds_landed = 2 THEN 'success' ELSE 'fail' END AS result FROM n"""


def _drift_sql() -> str:
    third = _THIRD.replace("ts", R.YP)
    return R.with_e("SELECT '2024' AS data_year, m AS data_month, count(*) AS n_rows, sum(passenger_count) AS passengers, "
                    "count(congestion_surcharge) FILTER (m <> '02') AS n_congestion, count(airport_fee) AS n_airport, "
                    f"min({R.YP}) AS first_pickup FROM (SELECT *, {third} AS m FROM raw_yellow) GROUP BY m")


def oracle_sql() -> dict[str, str]:
    return {
        "month_load_green": _loaded_sql("green"),
        "month_load_highvol": _loaded_sql("highvol"),
        "month_rejects_green": _rejects_sql("green"),
        "month_load_counts": _counts_sql(),
        "stream_warehouse_green": _loaded_sql("green"),
        "fact_csv_month": _loaded_sql("highvol"),
        **{n.replace("dim_", "dim_import_"): _import_sql(n)
           for n in ("dim_base", "dim_zone", "dim_date", "dim_time", "dim_flags")},
        "dim_import_rejects": _import_rejects_sql(),
        "star_profile": _profile_sql(True),
        "star_profile_reload": _profile_sql(False),
        "fk_audit_months": R.with_o(O.fk_audit_sql("green", "green_in"), None, _green_in()),
        "kpi_from_summary": R._sql_yoy(dict(metrics.MEASURES), by="payment_type"),
        "dashboard": _dashboard_sql(),
        "landing_gate_files": _gate_sql(),
        "feed_months_drift": _drift_sql(),
    }



