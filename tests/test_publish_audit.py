"""Publishing (P7, X1, K1-K4, F6, D13, D18) and audits (J14-J16, A14, A15),
landing gate (S10, from the two fetch tests of the original system)."""

import datetime as dt
import decimal
import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators import audit
from tripmart.operators.clean import clean
from tripmart.operators.dims import build_dims
from tripmart.operators.facts import build_fact
from tripmart.operators.publish import (conform, load_month, read_dim, read_fact, read_table,
                                        to_layout, write_table)
from tripmart.period import Period
from tripmart.plans.tables import ORDER_FACT_SCHEMA, published_orders
from tripmart.schemas import FACTS
from tripmart.session import path_exists, shared_path
from tripmart.sources.adapters import event_trips
from tripmart.sources.landing import landing_status, manifest_from_paths

from .conftest import SF001, SF01

P = Period("2024", "01")


def test_layout_names_follow_ddl(spark, dims):
    for feed in ("yellow", "green", "highvol"):
        lay = to_layout(build_fact(event_trips(spark, SF01, feed), feed, P, dims), feed)
        assert lay.columns == [c for c, _ in FACTS[feed]]


def test_conform_decimal_boundary(spark):
    rows = [(99999.99,), (99999.994,), (99999.995,), (-99999.995,), (100000.0,), (None,),
            (float("nan"),), (1e300,), (0.125,)]
    df = spark.createDataFrame(rows, "fare_amount double")
    cols = {c: F.lit(None).cast(t) for c, t in FACTS["green"] if c != "fare_amount"}
    good, rej = conform(df.withColumns(cols), "green")
    assert sorted(r.fare_amount for r in good.collect() if r.fare_amount is not None) == [
        decimal.Decimal("0.13"), decimal.Decimal("99999.99"), decimal.Decimal("99999.99")]
    assert good.filter("fare_amount is null").count() == 1          # null is not a reject
    assert rej.count() == 5 and {r.reject_reason for r in rej.collect()} == {"fare_amount"}
    # same split as try_cast
    tc = df.select(F.col("fare_amount").try_cast("decimal(7,2)").alias("x"))
    assert tc.filter("x is null").count() == 6


def test_conform_rejects_count(spark):
    f = published_orders(spark, SF01).fact
    _, rej = conform(f.withColumns({c: F.lit(None).cast(t) for c, t in FACTS["green"]
                                    if c not in f.columns}), "green")
    assert rej.filter(F.col("reject_reason").contains("fare_amount")).count() == 2824


def test_conform_varchar(spark):
    df = spark.createDataFrame([("2024", "01"), ("2024", "123")], "data_year string, data_month string")
    cols = {c: F.lit(None).cast(t) for c, t in FACTS["yellow"] if not c.startswith("data_")}
    good, rej = conform(df.withColumns(cols), "yellow")
    assert good.count() == 1 and rej.first().reject_reason == "data_month"


def test_load_month_is_idempotent_and_isolated(spark):
    f = published_orders(spark, SF01).fact
    path = shared_path(spark, "test", "load")
    nov, dec = Period("1997", "11"), Period("1997", "12")
    load_month(f, path, nov)
    load_month(f, path, dec)
    once = read_fact(spark, path, ORDER_FACT_SCHEMA)
    n_nov = once.filter("data_year = '1997' and data_month = '11'").count()
    n_dec = once.filter("data_month = '12'").count()
    rows_once = sorted(map(tuple, once.collect()), key=repr)
    load_month(f, path, nov)                       # again: same state
    twice = read_fact(spark, path, ORDER_FACT_SCHEMA)
    assert sorted(map(tuple, twice.collect()), key=repr) == rows_once
    # a smaller reload of November replaces November only
    load_month(f.filter("payment_id = 1"), path, nov)
    after = read_fact(spark, path, ORDER_FACT_SCHEMA)
    assert after.filter("data_month = '12'").count() == n_dec
    assert 0 < after.filter("data_month = '11'").count() < n_nov
    assert after.schema["data_month"].dataType == T.StringType()


def test_csv_roundtrips(spark, dims):
    fact = build_fact(event_trips(spark, SF01, "yellow"), "yellow", P, dims)
    p = shared_path(spark, "test", "csv")
    write_table(fact, p, "csv")
    back = read_table(spark, p, fact.schema, "csv")
    assert back.exceptAll(fact).count() == 0 and fact.exceptAll(back).count() == 0
    base = published_orders(spark, SF01).dims.base
    p2 = shared_path(spark, "test", "dimcsv")
    write_table(base, p2, "csv")
    assert read_dim(spark, "dim_base", p2, "csv").exceptAll(base).count() == 0


def test_csv_failfast_on_malformed(spark):
    p = shared_path(spark, "test", "bad")
    spark.createDataFrame([("x", "y")], "a string, b string").write.option("header", True).csv(p)
    with pytest.raises(Exception):
        read_dim(spark, "dim_time", p, "csv").collect()


def test_fk_audit_counts_orphans_not_nulls(spark):
    dims = build_dims(spark)
    rows = [(1, 20240101), (1, 20240101), (7, 20240101), (None, 20240101), (2, 19000101)]
    fact = spark.createDataFrame(rows, "vendor_id int, pickup_date_id int")
    cols = {c: F.lit(None).cast(t) for c, t in FACTS["yellow"] if c not in fact.columns}
    res = {r.fk_column: r for r in audit.fk_audit(fact.withColumns(cols), dims, "yellow").collect()}
    assert (res["vendor_id"].checked_rows, res["vendor_id"].orphan_rows,
            res["vendor_id"].orphan_keys) == (4, 1, 1)
    assert (res["pickup_date_id"].orphan_rows, res["pickup_date_id"].orphan_keys) == (1, 1)
    # no zone dimension given: the two location FKs are listed unchecked
    assert res["payment_id"].checked_rows == 0 and len(res) == 9
    assert sorted(c for c, r in res.items() if not r.checked) == ["do_location_id", "pu_location_id"]
    assert all(r.checked_rows is None for r in res.values() if not r.checked)


def test_lookup_csv_with_standard_quoting(spark, tmp_path):
    (tmp_path / "base.csv").write_text('a,b\nB1,"JOE ""THE"" CAB, INC"\n')
    from tripmart.operators.publish import read_table
    assert read_table(spark, str(tmp_path), T.StructType([T.StructField("a", T.StringType()),
                      T.StructField("b", T.StringType())]), "csv").collect()[0].b == 'JOE "THE" CAB, INC'


def test_month_reload_leaves_nothing_behind(spark):
    from tripmart.period import Period
    path, p = shared_path(spark, "test", "reload"), Period("2024", "01")
    rows = [(i, "2024", "01") for i in range(6)] + [(9, "2024", "02")]
    df = spark.createDataFrame(rows, "x int, data_year string, data_month string")
    load_month(df, path)
    for part, want in ((df.where("x < 2"), {0, 1, 9}), (df.where("false"), {9}), (df.where("x = 5"), {5, 9})):
        load_month(part, path, p)
        assert {r.x for r in read_fact(spark, path, df.schema).collect()} == want


def test_published_fact_follows_its_input(spark, tmp_path):
    import shutil
    from tests.conftest import SF001
    from tripmart.plans.tables import published_orders
    for n in ("lineitem", "orders", "customer", "supplier", "nation", "region"):
        shutil.copyfile(f"{SF001}/{n}.parquet", tmp_path / f"{n}.parquet")
    before = published_orders(spark, f"file://{tmp_path}").fact.count()
    rows = pq.read_table(f"{SF001}/lineitem.parquet")
    pq.write_table(rows.slice(0, rows.num_rows // 2), tmp_path / "lineitem.parquet")
    spark.catalog.refreshByPath(str(tmp_path))
    assert 0 < published_orders(spark, f"file://{tmp_path}").fact.count() < before


def test_pk_audit_flags_duplicates(spark):
    dims = build_dims(spark)
    legacy = dims.date.withColumn("dateid", F.concat("year", "month", "day").cast("int"))
    out = {r.table_name: r for r in audit.pk_audit({"dim_date": legacy,
                                                    "dim_time": dims.time}).collect()}
    assert out["dim_date"].duplicate_keys == 306 and out["dim_time"].duplicate_keys == 0
    assert out["dim_date"].n_rows == 6209


def test_key_misses_report_the_dropped_rows(spark):
    narrow = build_dims(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 30))
    m = {(r.role, r.kind): r.missing_rows for r in
         audit.key_misses(clean(event_trips(spark, SF01, "yellow"), "yellow"), narrow).collect()}
    assert m == {("pickup", "date"): 0, ("dropoff", "date"): 9, ("pickup", "time"): 0,
                 ("dropoff", "time"): 0}


def test_column_profile_approx_within_bound(spark):
    f = published_orders(spark, SF01).fact
    prof = audit.column_profile(f, ["fare_amount", "pickup_date_id"], rsd=0.05).first()
    for c in ("fare_amount", "pickup_date_id"):
        exact = f.select(c).distinct().count()
        assert abs(prof[f"{c}__approx_distinct"] - exact) <= 0.15 * exact
    assert prof.n_rows == 60000 and prof["fare_amount__nulls"] == 0


def test_landing_status_cases(spark):
    man = spark.createDataFrame(
        [("2024", "12", "yellow", "p1", 1), ("2024", "12", "green", "p2", 1),
         ("2024", "11", "yellow", "p3", 1)],
        "year string, month string, feed string, path string, bytes long")
    expected = spark.createDataFrame([("2024", "12"), ("2024", "11"), ("2024", "10")],
                                     "year string, month string")
    got = {r.month: r.result for r in landing_status(man, expected).collect()}
    assert got == {"12": "success", "11": "fail", "10": "fail"}


def test_manifest_from_paths(spark, tmp_path):
    for rel in ("2024/12/yellow_tripdata_2024-12", "2024/12/green_tripdata_2024-12",
                "2024/11/yellow_tripdata_2024-11", "2024/11/notes.txt"):
        p = tmp_path / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"x" * 10)
    man = manifest_from_paths(spark, str(tmp_path))
    rows = sorted((r.year, r.month, r.feed, r.bytes) for r in man.collect())
    assert rows == [("2024", "11", "yellow", 10), ("2024", "12", "green", 10),
                    ("2024", "12", "yellow", 10)]
    got = {r.month: r.result for r in landing_status(man).collect()}
    assert got == {"12": "success", "11": "fail"}
    assert os.path.exists(tmp_path / "2024/11/notes.txt")


def test_decimal_fit_rule_equals_try_cast(spark):
    # The one-comparison overflow test must agree with try_cast exactly,
    # including doubles next to the rounding boundary of each width.
    import math
    import random

    from tripmart.operators.publish import _decimal_fits
    rng = random.Random(7)
    values = []
    for p in (7, 8, 9):
        edge = 10.0 ** (p - 2) - 0.005
        x = edge
        for _ in range(40):                      # walk doubles across the edge
            values += [x, -x]
            x = math.nextafter(x, 0.0)
        x = edge
        for _ in range(40):
            x = math.nextafter(x, math.inf)
            values += [x, -x]
        values += [round(rng.uniform(-2 * edge, 2 * edge), rng.choice((2, 3, 6)))
                   for _ in range(500)]
    values += [0.0, -0.0, 1e308, -1e308, float("inf"), float("-inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for t in (T.DecimalType(7, 2), T.DecimalType(8, 2), T.DecimalType(9, 2)):
        bad = df.filter(_decimal_fits(F.col("x"), t) != F.col("x").try_cast(t).isNotNull())
        assert bad.count() == 0, bad.limit(5).collect()


def test_missing_feeds(spark):
    from tripmart.sources.landing import missing_feeds
    man = spark.createDataFrame(
        [("2024", "12", "yellow", "p1", 1), ("2024", "12", "green", "p2", 1),
         ("2024", "11", "yellow", "p3", 1), ("2024", "11", "yellow", "p4", 1)],
        "year string, month string, feed string, path string, bytes long")
    expected = spark.createDataFrame([("2024", "12"), ("2024", "11"), ("2024", "10")],
                                     "year string, month string")
    got = sorted(tuple(r) for r in missing_feeds(man, expected).collect())
    assert got == [("2024", "10", "green"), ("2024", "10", "yellow"), ("2024", "11", "green")]


def test_export_month_csv_takes_only_its_month(spark):
    from tripmart.operators.publish import export_month_csv
    f = published_orders(spark, SF01).fact
    root = shared_path(spark, "test", "export")
    path = export_month_csv(f, root, "green", Period("1997", "11"))
    back = read_table(spark, path, ORDER_FACT_SCHEMA, "csv")
    assert path.endswith("/Fact/green/1997/11")
    assert back.count() == f.filter("data_year = '1997' and data_month = '11'").count() > 0
    assert back.filter("data_month <> '11'").count() == 0


def test_warehouse_month_load_sees_stale_tables(spark, monkeypatch):
    """A load that leaves an emptied month as it was turns the query red."""
    from tripmart.operators import month
    from tripmart.plans import registry
    n = registry.q_warehouse_month_load(spark, SF001).count()
    assert n == registry.e_fact(spark, SF001, "yellow").count() > 0
    swap = month._swap

    def first_only(spark, path, staged, period):
        if not path_exists(spark, month._month_path(path, period)):
            swap(spark, path, staged, period)
    monkeypatch.setattr(month, "_swap", first_only)
    with pytest.raises(RuntimeError, match="landed last"):
        registry.q_warehouse_month_load(spark, SF001)


def test_a_large_month_is_sorted_by_several_tasks(spark, tmp_path):
    # Two input tasks hold the whole month.
    df = spark.range(200_000, numPartitions=2).select(
        (F.col("id") * 7919 % 1000003).alias("x"), (20240101 + F.col("id") % 28).cast("int").alias("pickup_date_id"),
        F.lit("2024").alias("data_year"), F.lit("01").alias("data_month"))
    key, path = "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(tmp_path / "t")
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "64k")
        load_month(df, path, Period("2024", "01"))
    finally:
        spark.conf.set(key, old)
    assert len([f for f in os.listdir(f"{path}/data_year=2024/data_month=01") if f.endswith(".parquet")]) > 2    # two before
    assert sorted(map(tuple, read_fact(spark, path, df.schema).collect())) == sorted(map(tuple, df.collect()))


def test_load_month_deals_small_months_together(spark, tmp_path):
    df = spark.range(4_000, numPartitions=8).select("id", F.lit("2024").alias("data_year"), F.lit("01").alias("data_month"))
    load_month(df, str(tmp_path / "t"))
    assert len(glob.glob(str(tmp_path / "t" / "*" / "*" / "*.parquet"))) == 1    # eight before: one per task
