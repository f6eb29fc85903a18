"""Column functions: durations (D9, truncation), keys (D1, D2), labels (C16,
C17, D11), ratios (D16), default period (S11)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions import (default_period_cols, growth, legacy_date_key, legacy_time_key,
                                month_label, pct_label, trip_minutes)
from tripmart.period import Period, default_period, month_number

from .conftest import plan_text, ts

NTZ = T.StructType([T.StructField("p", T.TimestampNTZType()), T.StructField("d", T.TimestampNTZType())])


def minutes(spark, pairs):
    df = spark.createDataFrame([(ts(a), ts(b)) for a, b in pairs], NTZ)
    return [r[0] for r in df.select(trip_minutes("p", "d")).collect()]


def test_duration_over_dst_start_is_wall_clock(spark):
    # 01:30 -> 03:30 on the US DST start day is 120 wall-clock minutes, also
    # when the session zone observes DST.
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert minutes(spark, [("2024-03-10 01:30:00", "2024-03-10 03:30:00")]) == [120]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_duration_truncates_toward_zero_and_keeps_negatives(spark):
    got = minutes(spark, [("2024-01-01 00:10:00", "2024-01-01 00:08:17"),   # -103 s
                          ("2024-01-01 00:10:00", "2024-01-01 00:11:59"),   # 119 s
                          ("2024-01-01 00:10:00.900", "2024-01-01 00:11:00.100")])
    # whole epoch seconds first (fractions dropped), then division
    assert got == [-1, 1, 1]


def test_legacy_key_examples(spark):
    df = spark.createDataFrame([(2023, 1, 11), (2023, 11, 1)], "y int, m int, d int")
    assert {r[0] for r in df.select(legacy_date_key("y", "m", "d")).collect()} == {2023111}
    t = spark.createDataFrame([(1, 10), (11, 0)], "h int, m int")
    assert {r[0] for r in t.select(legacy_time_key("h", "m")).collect()} == {"110"}


def test_month_label(spark):
    df = spark.createDataFrame([("01",), ("1",), ("12",), ("13",), (None,), ("x",)], "m string")
    got = [r[0] for r in df.select(month_label("m")).collect()]
    assert got == ["January", "January", "December", None, None, None]
    n = spark.createDataFrame([(11,), (0,)], "m int")
    assert [r[0] for r in n.select(month_label("m")).collect()] == ["November", None]


def test_growth_nulls_and_zero(spark):
    df = spark.createDataFrame([(110.0, 100.0), (5.0, None), (None, 5.0), (5.0, 0.0)],
                               "c double, p double")
    got = [r[0] for r in df.select(growth("c", "p")).collect()]
    assert got[0] == pytest.approx(0.1)
    assert got[1:] == [None, None, None]


def test_pct_label(spark):
    df = spark.createDataFrame([(-0.018809,), (0.5,), (None,)], "x double")
    assert [r[0] for r in df.select(pct_label("x")).collect()] == ["-1.88%", "50.00%", None]


def test_default_period_python():
    assert default_period("2024", "3") == Period("2024", "03")
    assert default_period(today=dt.date(2024, 2, 15)) == Period("2023", "11")
    assert default_period(year="2024", today=dt.date(2024, 2, 15)) == Period("2023", "11")
    assert str(Period("2023", "1")) == "2023-01"
    with pytest.raises(ValueError):
        Period("2023", "13")


def test_default_period_column(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 15),), (dt.date(2024, 5, 31),)], "d date")
    assert [tuple(r) for r in df.select(*default_period_cols("d")).collect()] == [
        ("2023", "11"), ("2024", "02")]


def test_month_number():
    assert month_number("November") == 11
    assert month_number("nov") == 11
    assert month_number("01") == 1
    assert month_number(12) == 12
    with pytest.raises(ValueError):
        month_number("Januray-ish")
    with pytest.raises(ValueError):
        month_number(0)


def test_in_date_range_is_pushable(spark, tmp_path):
    from tripmart.functions import in_date_range
    p = str(tmp_path / "t")
    spark.createDataFrame([(ts("2024-01-05 10:00:00"), ts("2024-01-05 10:00:00"))], NTZ) \
        .write.parquet(p)
    df = spark.read.parquet(p).filter(in_date_range("p", dt.date(2024, 1, 1), dt.date(2024, 1, 31)))
    plan = plan_text(df)
    assert "GreaterThanOrEqual(p," in plan and "LessThan(p," in plan
    assert df.count() == 1
    assert spark.read.parquet(p).filter(
        in_date_range(F.col("p"), dt.date(2024, 1, 6), dt.date(2024, 1, 31))).count() == 0
