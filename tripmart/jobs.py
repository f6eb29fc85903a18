"""User-level jobs: publish the dimensions, load one month of a feed.

``python -m tripmart.jobs month --landing L --warehouse W [--year Y --month M]``
is the replacement of the original ``<script> <year> <month>`` step: it
checks that the month has landed, builds the fact of every feed, conforms it
to the warehouse types (rejects go to their own table) and replaces exactly
that month in the fact table.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators.audit import miss_counts, pk_audit
from .operators.clean import clean
from .operators.dims import DATE_END, DATE_START, Dims, build_dims, dims_from_tables
from .operators.facts import build_fact, key_fact
from .operators.month import read_months, replace_month
from .operators.publish import read_table, tag_conformance, to_layout, write_table
from .period import Period, default_period
from .schemas import DIM_BASE, DIM_ZONE, DIMS, RAW
from .session import path_exists
from .sources.feeds import read_feed
from .sources.landing import REQUIRED_FEEDS, landing_status, manifest_from_paths


class IncompleteMonth(RuntimeError):
    pass


class KeyViolation(RuntimeError):
    pass


class NothingLoaded(RuntimeError):
    pass


def require_landed(manifest: DataFrame, period: Period,
                   feeds: Sequence[str] = REQUIRED_FEEDS) -> None:
    """Raise unless every feed of ``period`` has landed (the original flow
    went on to load after a failed fetch)."""
    months = manifest.sparkSession.createDataFrame([(period.year, period.month)],
                                                   "year string, month string")
    row = landing_status(manifest, months, feeds).first()
    if row is None or row["result"] != "success":
        raise IncompleteMonth(f"{period}: {0 if row is None else row['feeds_landed']} of "
                              f"{len(feeds)} feeds landed")


def publish_dims(dims: Dims, root: str) -> list:
    """Audit every dimension's primary key, then write each dimension as
    Parquet to its own folder ``<root>/<name>``. Raises ``KeyViolation``
    (nothing written) when a key is null or duplicated. Returns the audit
    (one row per dimension)."""
    tables = dims.named()
    report = pk_audit(tables).collect()
    bad = [r for r in report if r.null_keys > 0 or r.duplicate_keys > 0]
    if bad:
        raise KeyViolation(", ".join(f"{r.table_name}.{r.key_column}" for r in bad))
    for name, df in tables.items():
        # Bounded dimensions become one file; a lookup that grows with the
        # data (base) keeps its partitioning instead of funnelling into one task.
        out = df.coalesce(1) if name.removeprefix("dim_") in dims.small else df
        write_table(out, f"{root.rstrip('/')}/{name}", "parquet")
    return report


def read_published_dims(spark: SparkSession, root: str) -> Dims:
    """The dimensions written by ``publish_dims`` (Parquet, one folder each),
    read with their declared schemas."""
    tables = {}
    for name in DIMS:
        path = f"{root.rstrip('/')}/{name}"
        if name in ("dim_zone", "dim_base") and not path_exists(spark, path):
            continue
        tables[name] = read_table(spark, path, DIMS[name], "parquet")
    return dims_from_tables(tables)


def read_lookup(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Zone or base lookup from a headered CSV file, typed by position."""
    return read_table(spark, path, {"zone": DIM_ZONE, "base": DIM_BASE}[kind], "csv")


_layouts: dict[str, T.StructType] = {}


def _layout(spark: SparkSession, feed: str) -> T.StructType:
    """The types that rejects of ``feed`` keep; the same for every month."""
    if feed not in _layouts:
        empty = spark.createDataFrame([], RAW[feed])
        _layouts[feed] = to_layout(build_fact(empty, feed, Period("2000", "01"), build_dims(spark)), feed).schema
    return _layouts[feed]


def month_table(warehouse: str, feed: str) -> str:
    return f"{warehouse.rstrip('/')}/trips_{feed}"


def read_loaded(spark: SparkSession, warehouse: str, feed: str) -> DataFrame:
    """The fact of ``feed``: conformed rows of all months loaded."""
    return _read(spark, warehouse, feed)[0]


def read_rejects(spark: SparkSession, warehouse: str, feed: str) -> DataFrame:
    """Rows of ``feed`` that no month could load, as they came, with the reason."""
    return _read(spark, warehouse, feed)[1]


def _read(spark: SparkSession, warehouse: str, feed: str) -> tuple[DataFrame, DataFrame]:
    return read_months(spark, month_table(warehouse, feed), feed, _layout(spark, feed))


def load_feed_month(spark: SparkSession, feed: str, period: Period, landing: str,
                    warehouse: str, dims: Dims) -> dict:
    """Build, conform and load one feed-month in one job and one step: conformed
    rows and rejects replace those of the month together, also when there are
    none (``read_loaded``, ``read_rejects``). The job itself counts the rows read,
    loaded and rejected, ``dropped`` (rows that the cleaning rules or a missing
    key left out) and the key misses per role; nothing is read twice. Raises
    ``NothingLoaded``, before anything is replaced, if the calendar does not
    cover the month."""
    if not (dims.date_start <= period.first_day() and period.last_day() <= dims.date_end):
        raise NothingLoaded(f"{feed} {period}: dim_date covers {dims.date_start} to {dims.date_end} only")
    read, misses = Observation(f"read {feed} {period}"), miss_counts(dims)
    raw = read_feed(spark, feed, period, landing).observe(read, F.count(F.lit(1)).alias("read"))
    cleaned = clean(raw, feed)
    missed = Observation(f"misses {feed} {period}")
    if misses:
        cleaned = cleaned.observe(missed, *misses)
    tagged = tag_conformance(to_layout(key_fact(cleaned, feed, period, dims), feed), feed)
    outcome = replace_month(tagged, month_table(warehouse, feed), feed, period)
    count = {**read.get, **outcome, **(missed.get if misses else {})}
    count["dropped"] = count["read"] - count["loaded"] - count["rejected"]
    return {"feed": feed, "period": str(period), **count}


def load_period(spark: SparkSession, period: Period, landing: str, warehouse: str,
                dims: Dims | None = None, feeds: Sequence[str] = REQUIRED_FEEDS) -> list[dict]:
    """Load ``feeds`` of a landed month. All required feeds must have landed,
    whichever are loaded; only that month's folder is listed. Without ``dims``
    the calendar is built to cover the month and its neighbours."""
    folder = f"{landing.rstrip('/')}/{period.year}/{period.month}"
    if not path_exists(spark, folder):
        raise IncompleteMonth(f"{period}: nothing landed")
    require_landed(manifest_from_paths(spark, folder), period, sorted({*REQUIRED_FEEDS, *feeds}))
    year = int(period.year)
    dims = dims or build_dims(spark, min(DATE_START, dt.date(year - 1, 1, 1)),
                              max(DATE_END, dt.date(year + 1, 12, 31)))
    return [load_feed_month(spark, f, period, landing, warehouse, dims) for f in feeds]


def main(argv: Sequence[str] | None = None) -> None:
    from .session import get_session
    ap = argparse.ArgumentParser(prog="tripmart.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    m = sub.add_parser("month", help="load one month of the trip feeds")
    m.add_argument("--landing", required=True)
    m.add_argument("--warehouse", required=True)
    m.add_argument("--year")
    m.add_argument("--month")
    m.add_argument("--feeds", default=",".join(REQUIRED_FEEDS))
    m.add_argument("--dims", help="folder written by the dims command (default: build them)")
    d = sub.add_parser("dims", help="publish the dimensions")
    d.add_argument("--warehouse", required=True)
    d.add_argument("--zone-csv")
    d.add_argument("--base-csv")
    d.add_argument("--start", default=DATE_START.isoformat())
    d.add_argument("--end", default=DATE_END.isoformat())
    a = ap.parse_args(argv)
    spark = get_session(app=f"tripmart-{a.cmd}")
    if a.cmd == "month":
        period = default_period(a.year, a.month)
        dims = read_published_dims(spark, a.dims) if a.dims else None
        print(load_period(spark, period, a.landing, a.warehouse, dims, feeds=a.feeds.split(",")))
    else:
        zone = read_lookup(spark, a.zone_csv, "zone") if a.zone_csv else None
        base = read_lookup(spark, a.base_csv, "base") if a.base_csv else None
        dims = build_dims(spark, dt.date.fromisoformat(a.start), dt.date.fromisoformat(a.end),
                          zone=zone, base=base)
        for row in publish_dims(dims, f"{a.warehouse.rstrip('/')}/dims"):
            print(row.asDict())


__all__ = ["DIMS", "IncompleteMonth", "KeyViolation", "NothingLoaded", "load_feed_month", "load_period",
           "publish_dims", "read_loaded", "read_lookup", "read_published_dims", "read_rejects", "require_landed"]

if __name__ == "__main__":
    main()
