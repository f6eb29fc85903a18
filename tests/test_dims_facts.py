"""Dimensions (S7-S9, D1, D2, D7, D8) and fact builds (T1-T3, F1, F2, J1-J5,
D10), including the metamorphic check join-form keys == arithmetic keys."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripmart.operators.clean import clean
from tripmart.operators.dims import (FLAG_ROWS, build_dim_date, build_dim_time, build_dims,
                                     build_literal_dim, legacy_dim_date, legacy_dim_time)
from tripmart.operators.facts import build_fact
from tripmart.operators.keys import add_flag_key, add_keys
from tripmart.period import Period
from tripmart.schemas import RAW_GREEN, RAW_HIGHVOL, RAW_YELLOW
from tripmart.sources.adapters import event_trips

from .conftest import SF01, ts

P = Period("2024", "01")


def test_dim_date_default_span_and_unique_key(spark):
    d = build_dim_date(spark)
    assert d.count() == 6209
    assert d.select("dateid").distinct().count() == 6209
    row = d.filter("full_date = date'2023-01-11'").first()
    assert (row.dateid, row.quarter, row.day_of_week, row.is_weekday, row.is_weekend) == (
        20230111, 1, 4, 1, 0)
    sunday = d.filter("full_date = date'2023-01-15'").first()
    assert (sunday.day_of_week, sunday.is_weekday, sunday.is_weekend) == (1, 0, 1)
    assert d.filter("full_date = date'2021-01-03'").first().week_number == 53  # ISO week


def test_legacy_date_key_collisions(spark):
    legacy = legacy_dim_date(build_dim_date(spark))
    clashes = legacy.groupBy("legacy_id").count().filter("count > 1")
    assert clashes.count() == 306
    assert clashes.agg(F.sum("count")).first()[0] == 612


def test_dim_time(spark):
    t = build_dim_time(spark)
    assert t.count() == 1440 and t.select("time_id").distinct().count() == 1440
    assert t.filter("hour = 23 and minute = 59").first().time_id == 2359
    clashes = legacy_dim_time(t).groupBy("legacy_id").count().filter("count > 1")
    assert clashes.count() == 80 and clashes.agg(F.sum("count")).first()[0] == 160


def test_dim_flags_has_sixteen_distinct_combinations(spark):
    f = build_literal_dim(spark, "dim_flags")
    assert f.count() == 16
    assert f.select("shared_request_flag", "shared_match_flag", "wav_request_flag",
                    "wav_match_flag").distinct().count() == 16
    assert dict((r[0], r[1:]) for r in FLAG_ROWS)[16] == ("N", "N", "N", "N")


def test_literal_dims(spark):
    counts = {n: build_literal_dim(spark, n).count()
              for n in ("dim_payment", "dim_ratecode", "dim_vendor", "dim_license", "dim_triptype")}
    assert counts == {"dim_payment": 6, "dim_ratecode": 6, "dim_vendor": 2, "dim_license": 4,
                      "dim_triptype": 2}


def test_dim_date_span_is_not_capped(spark):
    with pytest.raises(ValueError):
        build_dim_date(spark, dt.date(2025, 1, 2), dt.date(2025, 1, 1))
    assert build_dim_date(spark, dt.date(1700, 1, 1), dt.date(2025, 1, 1)).count() == 118_705


def _yellow_rows(spark, rows):
    """rows: (pickup, dropoff, total, passenger_count)."""
    base = dict(VendorID=1, trip_distance=1.0, RatecodeID=1.0, store_and_fwd_flag="N",
                PULocationID=1, DOLocationID=2, payment_type=1, fare_amount=5.0, extra=0.0,
                mta_tax=0.5, tip_amount=0.0, tolls_amount=0.0, improvement_surcharge=0.3,
                congestion_surcharge=0.0, airport_fee=0.0)
    data = []
    for p, d, total, pc in rows:
        r = dict(base, tpep_pickup_datetime=ts(p), tpep_dropoff_datetime=ts(d), total_amount=total,
                 passenger_count=pc)
        data.append(tuple(r[f.name] for f in RAW_YELLOW.fields))
    return spark.createDataFrame(data, RAW_YELLOW)


def test_total_amount_filter(spark, dims):
    df = _yellow_rows(spark, [("2024-01-01 10:00:00", "2024-01-01 10:05:00", -0.01, 1.0),
                              ("2024-01-01 10:00:00", "2024-01-01 10:05:00", 0.0, 1.0),
                              ("2024-01-01 10:00:00", "2024-01-01 10:05:00", None, 1.0)])
    out = build_fact(df, "yellow", P, dims).collect()
    assert [r.total_amount for r in out] == [0.0]


def test_yellow_keeps_nulls_keys_and_tags(spark, dims):
    df = _yellow_rows(spark, [("2024-01-31 23:55:00", "2024-02-01 00:10:00", 3.0, None)])
    r = build_fact(df, "yellow", P, dims).first()
    assert r.passenger_count is None
    assert (r.pickup_date_id, r.dropoff_date_id, r.pickup_time_id, r.dropoff_time_id) == (
        20240131, 20240201, 2355, 10)
    assert (r.trip_time, r.data_year, r.data_month) == (15, "2024", "01")


def test_out_of_range_trip_dropped(spark, dims):
    df = _yellow_rows(spark, [("2008-12-31 23:00:00", "2008-12-31 23:30:00", 3.0, 1.0)])
    assert build_fact(df, "yellow", P, dims).count() == 0
    assert build_fact(df, "yellow", P, dims, how="join").count() == 0


def test_green_any_null_rule_applies_after_casts(spark, dims):
    base = {f.name: None for f in RAW_GREEN.fields}
    base.update(VendorID=1, lpep_pickup_datetime=ts("2024-01-02 08:00:00"),
                lpep_dropoff_datetime=ts("2024-01-02 08:20:00"), store_and_fwd_flag="N",
                RatecodeID=1.0, PULocationID=1, DOLocationID=2, passenger_count=1.0,
                trip_distance=2.0, fare_amount=10.0, extra=0.0, mta_tax=0.5, tip_amount=0.0,
                tolls_amount=0.0, improvement_surcharge=0.3, total_amount=10.8, payment_type=1.0,
                trip_type=1.0, congestion_surcharge=0.0)
    ok = dict(base)
    null_tt = dict(base, trip_type=None)
    null_ehail = dict(base)  # ehail_fee is null in every row: not a required column
    rows = [tuple(r[f.name] for f in RAW_GREEN.fields) for r in (ok, null_tt, null_ehail)]
    out = build_fact(spark.createDataFrame(rows, RAW_GREEN), "green", P, dims)
    assert out.count() == 2
    assert "ehail_fee" not in out.columns and "store_and_fwd_flag" not in out.columns


def test_event_facts_match_fixture_counts(spark, dims):
    assert build_fact(event_trips(spark, SF01, "yellow"), "yellow", P, dims).count() == 7908
    assert build_fact(event_trips(spark, SF01, "green"), "green", P, dims).count() == 6644


@pytest.mark.parametrize("feed", ["yellow", "green", "highvol"])
def test_join_keys_equal_arithmetic_keys(spark, feed):
    narrow = build_dims(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 30))
    raw = event_trips(spark, SF01, feed)
    a = build_fact(raw, feed, P, narrow, how="arith")
    j = build_fact(raw, feed, P, narrow, how="join").select(*a.columns)
    assert a.exceptAll(j).count() == 0 and j.exceptAll(a).count() == 0
    if feed == "yellow":
        assert a.count() == 7899


def test_highvol_flag_lookup_neither_drops_nor_duplicates(spark, dims):
    raw = event_trips(spark, SF01, "highvol")
    keyed = add_flag_key(raw, dims)
    assert keyed.count() == raw.count()
    assert keyed.select("flag_id").distinct().count() == 16


def test_highvol_fact_columns(spark, dims):
    f = build_fact(event_trips(spark, SF01, "highvol"), "highvol", P, dims)
    assert "trip_distance" not in f.columns and "trip_miles" in f.columns
    assert not {"request_datetime", "on_scene_datetime", "access_a_ride_flag",
                "shared_request_flag"} & set(f.columns)
    secs = event_trips(spark, SF01, "highvol").filter("trip_time = -103").count()
    assert f.filter("trip_time = -1").count() == secs


def test_clean_keeps_timestamps_for_keys(spark):
    c = clean(event_trips(spark, SF01, "yellow"), "yellow")
    assert {"pickup_datetime", "dropoff_datetime", "pickup_year", "dropoff_minute"} <= set(c.columns)
    assert "store_and_fwd_flag" not in c.columns
    k = add_keys(c, build_dims(spark))
    assert not {"pickup_datetime", "pickup_year"} & set(k.columns)


def test_highvol_raw_schema_has_flags():
    names = [f.name for f in RAW_HIGHVOL.fields]
    assert names.count("shared_request_flag") == 1 and "trip_miles" in names


def test_arithmetic_keys_ignore_session_time_zone(spark):
    narrow = build_dims(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 30))
    raw = event_trips(spark, SF01, "yellow")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")   # UTC+14
        a = build_fact(raw, "yellow", P, narrow).collect()
        j = build_fact(raw, "yellow", P, narrow, how="join").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert len(a) == len(j) == 7899
    assert sorted(map(tuple, a), key=repr) == sorted(map(tuple, j), key=repr)


def test_file_period_tag_is_not_the_calendar(spark, dims):
    # D12: a February trip found in the January file keeps the January tag;
    # calendar analysis goes through its date key.
    from tripmart.operators import metrics
    from tripmart.operators.star import star_view
    df = _yellow_rows(spark, [("2024-02-03 10:00:00", "2024-02-03 10:20:00", 7.0, 1.0),
                              ("2023-02-05 10:00:00", "2023-02-05 10:20:00", 5.0, 1.0)])
    fact = to_layout_yellow(build_fact(df, "yellow", P, dims))
    row = fact.orderBy("pickup_date_id").collect()[-1]
    assert (row.data_year, row.data_month, row.pickup_date_id) == ("2024", "01", 20240203)
    v = star_view(fact, dims, include=("date",))
    assert metrics.in_period(v, 2024, 2).count() == 1
    assert metrics.in_period(v, 2024, 1).count() == 0
    k = metrics.yoy(v, "revenue", 2024, "February").first()
    assert k.yoy_revenue == pytest.approx(7.0 / 5.0 - 1)


def to_layout_yellow(fact):
    from tripmart.operators.publish import to_layout
    return to_layout(fact, "yellow")


def test_calendar_of_the_data(spark):
    import datetime as dt
    from tripmart.operators.dims import build_dim_date, build_dim_date_over
    spans = spark.createDataFrame([(dt.date(2023, 12, 30), None), (None, None), (dt.date(2024, 2, 1), dt.date(2025, 1, 1))],
                                  "lo date, hi date")
    want = build_dim_date(spark, dt.date(2023, 1, 1), dt.date(2025, 12, 31))
    got = build_dim_date_over(spans)
    assert [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert build_dim_date_over(spans.limit(0)).count() == 0


def test_literal_dimensions_keep_their_types(spark):
    from tripmart import schemas
    from tripmart.operators.dims import LITERALS
    for name, rows in LITERALS.items():
        got = build_literal_dim(spark, name)
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in schemas.DIMS[name]]
        assert sorted(tuple(r) for r in got.collect()) == sorted(rows)
