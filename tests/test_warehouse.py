"""The warehouse side: one-step month loads, counts of the load itself, CSV
imports, profiles, summaries and audits kept by month, manifests, feeds of many
months, and the dashboard in one scan."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import jobs, schemas
from tripmart.operators import audit, dim_import, metrics, month, profile, summary
from tripmart.operators.clean import clean
from tripmart.operators.dims import Dims, build_dims
from tripmart.operators.publish import load_month, tag_conformance, write_table
from tripmart.period import Period
from tripmart.plans import registry, warehouse
from tripmart.session import path_exists, shared_path
from tripmart.sources.adapters import event_trips
from tripmart.sources.feeds import feed_path, read_feed
from tripmart.sources.landing import manifest_for, merge_manifest

from .conftest import SF001, plan_text

P = Period("2024", "01")


def rows(df):
    return sorted(map(str, df.collect()))


# ------------------------------------------------------------ one-step loads

def landed(spark, version):
    root = shared_path(spark, "test", "step")
    raw = event_trips(spark, SF001, "yellow")
    # Vendor 1's rows become rejects in the second version.
    if version:
        raw = raw.withColumn("fare_amount", F.when(F.col("VendorID") == 1, 1e12).otherwise(F.col("fare_amount")))
    write_table(raw, feed_path(root, "yellow", P), "parquet")
    return root


def state(spark, wh):
    return jobs.read_loaded(spark, wh, "yellow").count(), jobs.read_rejects(spark, wh, "yellow").count()


@pytest.mark.parametrize("dies", ["before the swap", "between the renames"])
def test_a_load_that_dies_leaves_both_old_or_both_new(spark, dims, monkeypatch, dies):
    wh = shared_path(spark, "test", "wh_step")
    table = jobs.month_table(wh, "yellow")
    jobs.load_feed_month(spark, "yellow", P, landed(spark, 0), wh, dims)
    old = state(spark, wh)
    assert old[0] > 0 and old[1] == 0
    swap = month._swap

    def broken(spark, path, staged, period):
        if dies == "between the renames":
            fs, at = month._fs(spark, path)
            fs.mkdirs(at(f"{path}/_old"))
            fs.rename(at(month._month_path(path, period)), at(f"{path}/_old/x"))
        raise OSError("executor and driver are gone")
    monkeypatch.setattr(month, "_swap", broken)
    with pytest.raises(OSError):
        jobs.load_feed_month(spark, "yellow", P, landed(spark, 1), wh, dims)
    monkeypatch.setattr(month, "_swap", swap)
    done = month.finish_swaps(spark, table)
    new = state(spark, wh)
    if dies == "before the swap":
        assert done == 0 and new == old
    else:
        assert done == 1 and 0 < new[0] < old[0] and new[0] + new[1] == old[0]
    # The next load starts clean and replaces the month whole.
    jobs.load_feed_month(spark, "yellow", P, landed(spark, 0), wh, dims)
    assert state(spark, wh) == old and month.finish_swaps(spark, table) == 0


def test_an_outcome_that_empties_goes(spark, dims):
    wh = shared_path(spark, "test", "wh_empty")
    for version in (1, 0):
        root = landed(spark, version)
        out = jobs.load_feed_month(spark, "yellow", P, root, wh, dims)
    assert out["rejected"] == 0 and not path_exists(
        spark, month._month_path(jobs.month_table(wh, "yellow"), P) + "/outcome=rejected")
    empty = shared_path(spark, "test", "none")
    write_table(event_trips(spark, SF001, "yellow").limit(0), feed_path(empty, "yellow", P), "parquet")
    out = jobs.load_feed_month(spark, "yellow", P, empty, wh, dims)
    assert (out["read"], out["loaded"], out["dropped"]) == (0, 0, 0) and state(spark, wh) == (0, 0)


def test_counts_of_the_load_equal_separate_counts(spark):
    dims = build_dims(spark, P.first_day(), P.last_day())
    root, wh = landed(spark, 1), shared_path(spark, "test", "wh_counts")
    out = jobs.load_feed_month(spark, "yellow", P, root, wh, dims)
    raw = read_feed(spark, "yellow", P, root)
    assert out["read"] == raw.count() and state(spark, wh) == (out["loaded"], out["rejected"])
    misses = {f"{r.role}_{r.kind}_misses": r.missing_rows for r in audit.key_misses(clean(raw, "yellow"), dims).collect()}
    assert misses == {k: out[k] for k in misses} and len(misses) == 4


def test_misses_by_range_equal_those_by_join(spark):
    dims = build_dims(spark, P.first_day(), P.first_day().replace(day=20))
    trips = clean(event_trips(spark, SF001, "yellow"), "yellow")
    by_range = rows(audit.key_misses(trips, dims))
    dims.date_contiguous = False
    assert by_range == rows(audit.key_misses(trips, dims)) and "missing_rows=0" in by_range[1]


def test_widths_count_bytes(spark):
    cols = {c: F.lit(None).cast(t) for c, t in schemas.FACTS["highvol"]}
    cols["license_number"] = F.col("v")
    df = spark.createDataFrame([("é" * 10,), ("é" * 11,), ("x" * 20,), ("x" * 21,)], "v string").select(
        *[v.alias(c) for c, v in cols.items()])
    assert [r["__reject"] for r in tag_conformance(df, "highvol").collect()] == [False, True, False, True]


# ------------------------------------------------------------ dimension imports

def test_import_keeps_what_it_cannot_load(spark):
    path = shared_path(spark, "test", "zones")
    lines = ["location_id,borough,zone,service_zone", '1,Queens,"Astoria, ""North""",Boro', "2,,,", "x,Queens,a,b",
             "3,Queens,a", "4,a,b,c,d", ",Queens,a,b", "5," + "é" * 11 + ",a,b", "6," + "é" * 10 + ",a,b", '7,"open,a,b']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    good, bad = dim_import.import_dim(spark, "dim_zone", path)
    assert {r.location_id: r.zone for r in good.collect()} == {1: 'Astoria, "North"', 2: None, 6: "a"}
    assert dict(good.dtypes)["location_id"] == "int"
    reasons = {r.line: r.reason for r in bad.collect()}
    assert reasons["x,Queens,a,b"] == "location_id not int" and reasons["3,Queens,a"] == "malformed line"
    assert reasons["4,a,b,c,d"] == "malformed line" and reasons[",Queens,a,b"] == "location_id empty"
    assert reasons["5," + "é" * 11 + ",a,b"] == "borough wider than 20" and len(reasons) == 6


def test_every_dimension_round_trips(spark, dims):
    for name, df in dims.named().items():
        path = shared_path(spark, "test", name)
        dim_import.export_dim(df, name, path)
        good, bad = dim_import.import_dim(spark, name, path)
        if name == "dim_ratecode":  # "Nassau or Westchester" has 21 letters, the column 20
            assert [r.reason for r in bad.collect()] == ["ratecode wider than 20"]
            continue
        assert rows(good) == rows(df) and bad.isEmpty()
    empty = shared_path(spark, "test", "no_zone")
    spark.createDataFrame([], schemas.DIM_ZONE).write.option("header", True).csv(empty)
    good, bad = dim_import.import_dim(spark, "dim_zone", empty)
    assert good.isEmpty() and bad.isEmpty()


def test_ddl_values():
    """Types, widths and keys as the warehouse declares them, stated once more."""
    assert {c: t.simpleString() for c, t in schemas.FACTS["yellow"]}["trip_distance"] == "decimal(9,2)"
    assert {c: t.simpleString() for c, t in schemas.FACTS["green"]}["trip_distance"] == "decimal(8,2)"
    for feed, n, money in (("yellow", 9, "decimal(7,2)"), ("green", 8, "decimal(7,2)"), ("highvol", 9, "decimal(8,2)")):
        kinds = [t.simpleString() for c, t in schemas.FACTS[feed] if c != "trip_distance"]
        assert kinds.count(money) == n
    assert [len(audit.FKS[f]) for f in ("yellow", "green", "highvol")] == [9, 10, 10]
    assert schemas.DIM_KEYS == {
        "dim_date": "dateid", "dim_time": "time_id", "dim_flags": "id", "dim_payment": "payment_id",
        "dim_ratecode": "ratecode_id", "dim_vendor": "vendor_id", "dim_zone": "location_id",
        "dim_license": "license_number", "dim_triptype": "triptypeid", "dim_base": "license_no"}
    assert schemas.VARCHAR["data_year"] == 4 and schemas.VARCHAR["data_month"] == 2


# ------------------------------------------------------------ kept by month

def test_profile_of_months_equals_that_of_all(spark, dims):
    fact = spark.createDataFrame(
        [(1, 1.5, "2024", "01"), (2, None, "2024", "01"), (1, 7.0, "2024", "02"), (None, 1.5, "2024", "02")],
        "payment_id int, fare double, data_year string, data_month string")
    counts = profile.value_counts(fact, dims, ("payment",))
    got = {r.column_name: r for r in profile.merge_months(profile.month_profile(counts)).collect()}
    exact = {r.column_name: r.distinct_values for r in profile.exact_distinct(counts).collect()}
    fare = got["fact.fare"]
    assert (fare.n_rows, fare.null_rows, fare.min_num, fare.max_num, fare.estimate) == (4, 1, 1.5, 7.0, 2)
    name = got["dim_payment.payment_type"]
    assert (name.n_rows, name.null_rows, name.min_txt, name.max_txt) == (4, 1, "Cash", "Credit card")
    assert exact == {"fact.payment_id": 2, "fact.fare": 2, "fact.data_year": 1, "fact.data_month": 2,
                     "dim_payment.payment_id": 2, "dim_payment.payment_type": 2}
    assert profile.month_profile(profile.value_counts(fact.limit(0), dims, ("payment",))).isEmpty()


def test_estimates_stay_within_their_bound(spark):
    fact = spark.range(60_000).select("id", (F.col("id") % 977).alias("k"), F.lit("2024").alias("data_year"),
                                      F.when(F.col("id") % 2 == 0, "01").otherwise("02").alias("data_month"))
    counts = profile.value_counts(fact)
    got = {r.column_name: r.estimate for r in profile.merge_months(profile.month_profile(counts)).collect()}
    for name, n in (("fact.id", 60_000), ("fact.k", 977)):
        assert abs(got[name] - n) <= profile.estimate_bound() * n


def test_value_counts_scan_the_fact_once(spark):
    pub = registry.published_orders(spark, SF001)
    one = plan_text(profile._long(pub.fact, {c: c for c in pub.fact.columns}, []), "simple")
    assert one.count("FileScan parquet") == 1
    # What follows reads the written counts.
    assert "order_fact" not in plan_text(profile.value_counts(pub.fact, pub.dims), "simple")


def test_a_task_counts_the_values_of_one_column(spark, monkeypatch):
    fact = spark.createDataFrame([(1, "a", -0.0, "2024", "01"), (1, None, 0.0, "2024", "01"), (None, "a", None, "2024", "02")],
                                 "k int, t string, x double, data_year string, data_month string")
    plans, write = [], profile.written
    monkeypatch.setattr(profile, "written", lambda df, *parts: plans.append(plan_text(df, "simple")) or write(df, *parts))
    got = {(r.data_month, r.column_name, r.num, r.txt): r.n for r in profile.value_counts(fact).collect()}
    # No row per row and column: each column has an aggregation of its own.
    assert "Expand" not in plans[0] and plans[0].count("partial_count") == len(fact.columns)
    assert got == {("01", "fact.k", 1.0, None): 2, ("02", "fact.k", None, None): 1, ("01", "fact.t", None, "a"): 1,
                   ("01", "fact.t", None, None): 1, ("02", "fact.t", None, "a"): 1, ("01", "fact.x", 0.0, None): 2,
                   ("02", "fact.x", None, None): 1, ("01", "fact.data_year", None, "2024"): 2,
                   ("02", "fact.data_year", None, "2024"): 1, ("01", "fact.data_month", None, "01"): 2,
                   ("02", "fact.data_month", None, "02"): 1}


def test_summary_equals_the_fact(spark):
    pub = registry.published_orders(spark, SF001)
    kept = summary.summary_view(summary.summarize(pub.fact), pub.dims)
    view = registry.o_view(spark, SF001, include=("date", "payment", "triptype"))
    for by in ((), "payment_type", "trip_type"):
        a, b = (metrics.yoy(v, list(metrics.MEASURES), 1997, 11, by=by, drop_null=False) for v in (kept, view))
        assert rows(a) == rows(b)
    assert rows(metrics.total_by(kept, "fare", "trip_type")) == rows(metrics.total_by(view, "fare", "trip_type"))


def test_summary_replaces_the_file_month(spark):
    path = shared_path(spark, "test", "summary")
    kind = "total_amount double, fare_amount double, tip_amount double, trip_distance double, payment_id int, " \
           "pickup_date_id int, data_year string, data_month string"
    # A trip of February lies in January's file.
    jan = spark.createDataFrame([(1.0, 1.0, 0.0, 1.0, 1, 20240201, "2024", "01"), (2.0, 1.0, 0.0, 1.0, 1, 20240105, "2024", "01")], kind)
    feb = spark.createDataFrame([(4.0, 1.0, 0.0, 1.0, 1, 20240202, "2024", "02")], kind)
    summary.load_summary(summary.summarize(jan.union(feb)), path)
    summary.load_summary(summary.summarize(jan.where("pickup_date_id < 20240201")), path, Period("2024", "01"))
    got = spark.read.schema(summary.summarize(jan).schema).parquet(path)
    assert {(r.data_month, r.month): (r.n_trips, r.total_amount) for r in got.collect()} == {
        ("01", 1): (1, 2.0), ("02", 2): (1, 4.0)}


def test_audit_of_months_equals_the_whole(spark, dims):
    fact = warehouse._green_fact(spark, SF001)
    path = shared_path(spark, "test", "fk")
    by = ("data_year", "data_month")
    load_month(audit.fk_key_counts(fact, "green", by), path)
    some = audit.fk_key_counts(fact, "green", by)
    kept = spark.read.schema(some.schema).parquet(path)
    assert rows(audit.fk_audit_of(kept, dims, "green")) == rows(audit.fk_audit(fact, dims, "green"))


def test_audit_without_dimensions_lists_every_key(spark):
    none = Dims(*[None] * 8)
    out = audit.fk_audit(warehouse._green_fact(spark, SF001), none, "green").collect()
    assert len(out) == 10 and not any(r.checked for r in out) and all(r.orphan_rows is None for r in out)


# ------------------------------------------------------------ dashboard, files

def test_dashboard_equals_the_single_queries_in_one_scan(spark):
    view = registry.o_view(spark, SF001, include=("date", "payment", "triptype"))
    board = metrics.dashboard(view, 1997, "November")
    tile = lambda t, *c: board.where(F.col("tile") == t).select(*c)
    assert rows(tile("kpi", "yoy_revenue", "yoy_fare", "yoy_tip", "yoy_distance")) == rows(metrics.kpi_all(view, 1997, 11))
    for m in ("revenue", "fare"):
        one = metrics.yoy(view, m, 1997, 11, by="payment_type").withColumnRenamed("payment_type", "member")
        assert rows(tile("payment_type", "member", f"yoy_{m}").where(F.col(f"yoy_{m}").isNotNull())) == rows(one)
    share = metrics.share_of_total(view, "fare", "trip_type").withColumnRenamed("trip_type", "member")
    assert rows(tile("trip_type", "member", "total_fare", "share_fare")) == rows(share)
    assert plan_text(board, "simple").count("Location: InMemoryFileIndex") == 1
    assert metrics.dashboard(view.limit(0), 1997, 11).isEmpty()


def test_a_listing_touches_only_the_months_asked_for(spark):
    root, kept = shared_path(spark, "test", "months"), shared_path(spark, "test", "manifest")
    raw = event_trips(spark, SF001, "yellow").limit(1)
    jan, feb, mar = (Period("2024", m) for m in ("01", "02", "03"))
    for p in (jan, feb):
        write_table(raw, feed_path(root, "yellow", p), "parquet")
    assert {r.month for r in manifest_for(spark, root, [feb, mar]).collect()} == {"02"}
    assert manifest_for(spark, root, [mar]).isEmpty()
    merge_manifest(spark, kept, root, [jan, feb, mar])
    fs, at = month._fs(spark, root)
    fs.delete(at(f"{root}/2024/01"), True)
    fs.delete(at(f"{root}/2024/02"), True)
    got = merge_manifest(spark, kept, root, [feb])       # January is not listed again
    assert {r.month for r in got.collect()} == {"01"}


def test_many_months_are_one_scan_per_schema(spark):
    root = shared_path(spark, "test", "many")
    raw = event_trips(spark, SF001, "yellow").limit(2).coalesce(1)
    other = raw.withColumn("passenger_count", F.col("passenger_count").cast("bigint")).drop("airport_fee")
    periods = [Period(str(2001 + i // 12), f"{i % 12 + 1:02d}") for i in range(24)]
    for i, p in enumerate(periods):
        write_table(other if i % 3 == 0 else raw, feed_path(root, "yellow", p), "parquet")
    df = read_feed(spark, "yellow", periods, root, tag=True)
    assert plan_text(df, "simple").count("FileScan parquet") == 2
    got = {(r.data_year, r.data_month): r["count"] for r in df.groupBy("data_year", "data_month").count().collect()}
    assert got == {(p.year, p.month): 2 for p in periods}
    assert df.schema.fieldNames()[:-2] == schemas.RAW["yellow"].fieldNames() and isinstance(df.schema["airport_fee"].dataType, T.DoubleType)
