"""User-level jobs: landing gate (D19), month load from landed files
(S1-S3, T1, T2, T4, K3), dimension publish gated by the key audit (D3, D6),
lookup CSV reads (S5, S6), streaming month load."""

import pytest
from pyspark.sql import functions as F

from tripmart.jobs import (IncompleteMonth, KeyViolation, load_period, publish_dims, read_loaded, read_lookup,
                           read_rejects, require_landed)
from tripmart.operators.dims import build_dims
from tripmart.operators.facts import build_fact
from tripmart.operators.publish import conform, read_fact, to_layout, write_table
from tripmart.period import Period
from tripmart.schemas import fact_schema
from tripmart.session import shared_path
from tripmart.sources.adapters import event_trips, zone_lookup
from tripmart.sources.feeds import feed_path, read_feed
from tripmart.sources.landing import manifest_from_paths
from tripmart.streaming.month_loader import start_month_loader

from .conftest import SF001

P = Period("2024", "01")


@pytest.fixture(scope="module")
def landing(spark):
    root = shared_path(spark, "test", "landing")
    for feed in ("yellow", "green", "highvol"):
        write_table(event_trips(spark, SF001, feed), feed_path(root, feed, P), "parquet")
    write_table(event_trips(spark, SF001, "yellow"), feed_path(root, "yellow", Period("2024", "02")),
                "parquet")
    return root


def test_read_feed_reads_landed_months(spark, landing):
    one = read_feed(spark, "yellow", P, landing)
    both = read_feed(spark, "yellow", [P, Period("2024", "02")], landing)
    assert both.count() == 2 * one.count() == 2 * event_trips(spark, SF001, "yellow").count()


def test_require_landed(spark, landing):
    man = manifest_from_paths(spark, landing)
    require_landed(man, P)
    with pytest.raises(IncompleteMonth):
        require_landed(man, Period("2024", "02"))      # green missing
    with pytest.raises(IncompleteMonth):
        require_landed(man, Period("2024", "03"))      # nothing landed


def test_load_period_builds_conforms_and_loads(spark, landing, dims):
    wh = shared_path(spark, "test", "warehouse")
    feeds = ("yellow", "green", "highvol")
    load_period(spark, P, landing, wh, dims, feeds)
    load_period(spark, P, landing, wh, dims, feeds)     # idempotent
    for feed in feeds:
        got = read_loaded(spark, wh, feed)
        good, _ = conform(to_layout(build_fact(event_trips(spark, SF001, feed), feed, P, dims),
                                    feed), feed)
        assert got.exceptAll(good).count() == 0 and good.exceptAll(got).count() == 0


def test_publish_dims(spark, dims):
    root = shared_path(spark, "test", "dims")
    report = publish_dims(dims, root)
    assert len(report) == 8 and all(r.duplicate_keys == 0 for r in report)
    back = spark.read.parquet(f"{root}/dim_flags")
    assert back.count() == 16
    bad = build_dims(spark)
    bad.payment = bad.payment.unionByName(bad.payment)
    with pytest.raises(KeyViolation):
        publish_dims(bad, shared_path(spark, "test", "dims_bad"))


def test_read_lookup_csv(spark):
    p = shared_path(spark, "test", "zone_csv")
    zone_lookup(spark, SF001).coalesce(1).write.option("header", True).csv(p)
    z = read_lookup(spark, p, "zone")
    assert z.count() == 25 and dict(z.dtypes)["location_id"] == "int"


def test_streaming_month_load(spark, landing, dims):
    table = shared_path(spark, "test", "stream_fact")
    q = start_month_loader(spark, "yellow", landing, table, dims,
                           shared_path(spark, "test", "stream_ckpt"))
    q.awaitTermination()
    assert q.exception() is None
    out = read_fact(spark, table, build_fact(event_trips(spark, SF001, "yellow"), "yellow", P,
                                             dims).schema)
    per_month = {r.data_month: r["count"] for r in out.groupBy("data_month").count().collect()}
    n = build_fact(event_trips(spark, SF001, "yellow"), "yellow", P, dims).count()
    assert per_month == {"01": n, "02": n}
    assert out.filter(F.col("data_year") != "2024").count() == 0


def test_highvol_rejects_go_to_their_table(spark, landing):
    from tripmart.sources.adapters import base_lookup
    dims = build_dims(spark, base=base_lookup(spark, SF001))
    wh = shared_path(spark, "test", "warehouse_hv")
    load_period(spark, P, landing, wh, dims, ("highvol",))
    good = read_loaded(spark, wh, "highvol")
    n = build_fact(event_trips(spark, SF001, "highvol"), "highvol", P, dims).count()
    assert good.count() == n
    assert read_rejects(spark, wh, "highvol").count() == 0


def test_streaming_keeps_a_month_whole_across_batches(spark, dims):
    root = shared_path(spark, "test", "landing_parts")
    table = shared_path(spark, "test", "stream_parts")
    ckpt = shared_path(spark, "test", "stream_parts_ckpt")
    raw = event_trips(spark, SF001, "yellow")
    part_a, part_b = raw.filter("passenger_count is null"), raw.filter("passenger_count is not null")
    month_dir = feed_path(root, "yellow", Period("2024", "03"))
    part_a.write.parquet(f"{month_dir}/a")
    q = start_month_loader(spark, "yellow", root, table, dims, ckpt)
    q.awaitTermination()
    part_b.write.parquet(f"{month_dir}/b")            # the rest of March lands later
    q = start_month_loader(spark, "yellow", root, table, dims, ckpt)
    q.awaitTermination()
    assert q.exception() is None
    schema = build_fact(raw, "yellow", P, dims).schema
    out = read_fact(spark, table, schema)
    expect = build_fact(raw, "yellow", Period("2024", "03"), dims)
    assert out.count() == expect.count()
    assert out.exceptAll(expect).count() == 0


def land_as(spark, df, path):
    """One Parquet file of ``df`` at ``path``, over the one that is there."""
    import glob
    import os
    import shutil
    tmp = shared_path(spark, "test", "land_as")
    df.coalesce(1).write.mode("overwrite").parquet(tmp)
    local = path.removeprefix("file://").removeprefix("file:")
    os.makedirs(os.path.dirname(local), exist_ok=True)
    shutil.copyfile(glob.glob(f"{tmp.removeprefix('file://').removeprefix('file:')}/part-*.parquet")[0], local)
    crc = f"{os.path.dirname(local)}/.{os.path.basename(local)}.crc"
    assert not os.path.exists(crc)


def test_streaming_reloads_changed_and_empty_months(spark, dims):
    root = shared_path(spark, "test", "landing_again")
    table, ckpt = shared_path(spark, "test", "stream_again"), shared_path(spark, "test", "stream_again_ckpt")
    raw = event_trips(spark, SF001, "yellow")
    path = feed_path(root, "yellow", Period("2024", "03"))
    schema = build_fact(raw, "yellow", P, dims).schema

    def loaded():
        q = start_month_loader(spark, "yellow", root, table, dims, ckpt)
        q.awaitTermination()
        assert q.exception() is None
        files = spark.read.format("binaryFile").load(f"{table}/data_year=2024/data_month=03")
        return read_fact(spark, table, schema).count(), {r.path for r in files.select("path").collect()}

    land_as(spark, raw, path)
    n, files = loaded()
    assert n == build_fact(raw, "yellow", P, dims).count() > 0
    assert loaded() == (n, files)                       # nothing changed: not loaded again
    some = raw.filter("passenger_count is null")
    land_as(spark, some, path)                          # the same path, other contents
    assert loaded()[0] == build_fact(some, "yellow", P, dims).count() < n
    land_as(spark, raw.limit(0), path)
    assert loaded()[0] == 0


def test_streaming_warehouse_load(spark, dims):
    from tripmart.streaming.month_loader import start_warehouse_loader
    root, wh = shared_path(spark, "test", "landing_wh"), shared_path(spark, "test", "stream_wh")
    ckpt = shared_path(spark, "test", "stream_wh_ckpt")
    raw = {f: event_trips(spark, SF001, f) for f in ("yellow", "green")}

    def loaded():
        q = start_warehouse_loader(spark, root, wh, ckpt, dims)
        q.awaitTermination()
        assert q.exception() is None

    def counts():
        return read_loaded(spark, wh, "yellow").count(), read_rejects(spark, wh, "yellow").count()

    bad = raw["yellow"].withColumn("total_amount", F.lit(1e12))
    write_table(bad, feed_path(root, "yellow", P), "parquet")
    loaded()                                            # green is missing: the month waits
    from tripmart.session import path_exists
    assert not path_exists(spark, f"{wh}/trips_yellow")
    write_table(raw["green"], feed_path(root, "green", P), "parquet")
    loaded()
    good, _ = conform(to_layout(build_fact(raw["yellow"], "yellow", P, dims), "yellow"), "yellow")
    n = good.count()
    assert n > 0 and counts() == (0, build_fact(bad, "yellow", P, dims).count())     # rejects only
    write_table(raw["yellow"], feed_path(root, "yellow", P), "parquet")
    loaded()
    assert counts() == (n, 0)
    got = read_loaded(spark, wh, "yellow")
    assert got.exceptAll(good).count() == 0


def test_published_dims_read_back(spark, dims):
    from tripmart.jobs import read_published_dims
    from tripmart.operators.dims import dims_from_tables
    root = shared_path(spark, "test", "dims_rt")
    publish_dims(dims, root)
    back = read_published_dims(spark, root)
    assert back.date_contiguous and back.time_complete
    assert (back.date_start, back.date_end) == (dims.date_start, dims.date_end)
    raw = event_trips(spark, SF001, "yellow")
    a = build_fact(raw, "yellow", P, dims)
    b = build_fact(raw, "yellow", P, back)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # a dimension with a hole (2024-01-15 missing) cannot use the arithmetic path
    gapped = dict(back.named())
    gapped["dim_date"] = back.date.filter("full_date <> date'2024-01-15'")
    g = dims_from_tables(gapped)
    assert not g.date_contiguous
    out = build_fact(raw, "yellow", P, g)
    assert out.filter("pickup_date_id = 20240115 or dropoff_date_id = 20240115").count() == 0
    assert out.count() == a.filter(
        "pickup_date_id <> 20240115 and dropoff_date_id <> 20240115").count()


def test_months_with_drifting_physical_schemas(spark, dims):
    from pyspark.sql import functions as F
    root = shared_path(spark, "test", "landing_drift")
    raw = event_trips(spark, SF001, "yellow")
    jan, feb = Period("2024", "01"), Period("2024", "02")
    write_table(raw, feed_path(root, "yellow", jan), "parquet")
    drifted = (raw.withColumn("passenger_count", F.col("passenger_count").cast("bigint"))
                  .withColumn("VendorID", F.col("VendorID").cast("int"))
                  .withColumnRenamed("airport_fee", "Airport_fee")
                  .drop("congestion_surcharge"))
    write_table(drifted, feed_path(root, "yellow", feb), "parquet")
    both = read_feed(spark, "yellow", [jan, feb], root, tag=True)
    assert both.count() == 2 * raw.count()
    f = both.filter("data_month = '02'")
    assert dict(f.dtypes)["passenger_count"] == "double"
    assert f.filter("congestion_surcharge is not null").count() == 0
    assert f.filter("airport_fee is not null").count() == raw.count()
    table = shared_path(spark, "test", "stream_drift")
    q = start_month_loader(spark, "yellow", root, table, dims,
                           shared_path(spark, "test", "stream_drift_ckpt"))
    q.awaitTermination()
    assert q.exception() is None
    out = read_fact(spark, table, build_fact(raw, "yellow", P, dims).schema)
    assert {r.data_month: r["count"] for r in out.groupBy("data_month").count().collect()} == {
        "01": build_fact(raw, "yellow", jan, dims).count(),
        "02": build_fact(raw, "yellow", feb, dims).count()}


def test_documented_example_and_csv_export(spark, landing, dims):
    from tripmart import (build_fact, conform, export_month_csv, load_month, read_fact,
                          read_feed, star_view, to_layout, yoy)
    from tripmart.operators.publish import read_table
    warehouse = shared_path(spark, "test", "example_wh")
    fact = to_layout(build_fact(read_feed(spark, "green", P, landing), "green", P, dims), "green")
    good, rejects = conform(fact, "green")
    load_month(good, f"{warehouse}/fact_green", P)
    green = read_fact(spark, f"{warehouse}/fact_green", fact_schema("green"))
    assert green.count() == good.count() > 0 and rejects.count() == 0
    out = yoy(star_view(green, dims, include=("date", "payment")), "revenue", 2024, "January",
              by="payment_type", drop_null=False)
    assert out.count() == green.select("payment_id").distinct().count()
    path = export_month_csv(green, warehouse, "green", P)
    assert path.endswith("/Fact/green/2024/01")
    back = read_table(spark, path, green.schema, "csv")
    assert back.exceptAll(green).count() == 0 and green.exceptAll(back).count() == 0


def test_month_outside_the_calendar_is_refused(spark, landing, dims):
    from tripmart.jobs import NothingLoaded, load_feed_month
    with pytest.raises(NothingLoaded):
        load_feed_month(spark, "yellow", Period("2031", "05"), landing, shared_path(spark, "test", "wh"), dims)


def test_recent_month_loads_every_row(spark):
    from tripmart.jobs import load_period
    p, root = Period("2026", "09"), shared_path(spark, "test", "landing_2026")
    for feed in ("yellow", "green"):
        raw = event_trips(spark, SF001, feed)
        for c in [c for c in raw.columns if c.endswith("datetime")]:
            raw = raw.withColumn(c, F.col(c) + F.expr("make_dt_interval(974)"))
        write_table(raw, feed_path(root, feed, p), "parquet")
    for row in load_period(spark, p, root, shared_path(spark, "test", "wh_2026")):
        assert row["loaded"] + row["rejected"] > 0.5 * row["read"]


def test_cli_dims_then_month(spark, landing, capsys):
    from tripmart.jobs import main
    wh = shared_path(spark, "test", "cli_wh")
    main(["dims", "--warehouse", wh])
    main(["month", "--landing", landing, "--warehouse", wh, "--year", "2024", "--month", "1",
          "--dims", f"{wh}/dims"])
    printed = capsys.readouterr().out
    assert "dim_flags" in printed and "'period': '2024-01'" in printed
    for feed in ("yellow", "green"):
        n = read_loaded(spark, wh, feed).count()
        assert n == build_fact(event_trips(spark, SF001, feed), feed, P,
                               build_dims(spark)).count()


def test_a_watched_stream_lists_its_months_only(spark, dims):
    from tripmart.period import recent_periods
    from tripmart.streaming.month_loader import SEEN, changed_months
    root, table = shared_path(spark, "test", "landing_watch"), shared_path(spark, "test", "watch")
    ckpt = shared_path(spark, "test", "watch_ckpt")
    raw = event_trips(spark, SF001, "yellow")
    for p in (P, Period("2024", "02")):
        write_table(raw, feed_path(root, "yellow", p), "parquet")

    def run():
        q = start_month_loader(spark, "yellow", root, table, dims, ckpt, watch=lambda: [P, Period("2030", "01")])
        q.awaitTermination()
        assert q.exception() is None
        return spark.read.schema(SEEN).parquet(f"{ckpt}/months").collect()

    first = run()
    assert [(r.year, r.month) for r in first] == [("2024", "01")]
    assert run() == first                                # nothing changed
    write_table(raw.limit(7), feed_path(root, "yellow", P), "parquet")
    again = run()
    assert len(again) == 1 and again != first            # replaced, not added
    got = read_fact(spark, table, build_fact(raw, "yellow", P, dims).schema)
    assert {r.data_month for r in got.select("data_month").distinct().collect()} == {"01"}
    assert changed_months(spark, ["yellow"], root, f"{ckpt}/months", []) == []
    assert [r.month for r in changed_months(spark, ["yellow"], root, f"{ckpt}/months")] == ["02"]
    import datetime as dt
    assert [str(p) for p in recent_periods(3, 1, dt.date(2024, 2, 29))] == ["2023-11", "2023-12", "2024-01"]
    assert recent_periods(0) == []
