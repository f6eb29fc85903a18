"""Adapters that shape the driver's test tables like the trip feeds.

* ``event_trips``: ``events`` -> a raw yellow / green / highvol month
  (cleaning, durations, keys);
* ``order_trips``: lineitem ⋈ orders ⋈ customer ⋈ supplier -> trip-shaped
  rows with money as decimals (star queries, KPIs);
* ``zone_lookup`` (nation ⋈ region), ``base_lookup`` (supplier), and the
  landing manifest (months of ``order_trips``).

Every expression has a DuckDB twin in ``plans.oracle``; keep them in step.
All adapters read whole tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import trip_minutes, trip_parts
from ..operators.publish import rebalanced
from ..plans.joins import dealt, join_lookup


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _events(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    e = F.col("event_id")
    secs = F.when(e % 50 == 0, F.lit(-103).cast("bigint")).otherwise(
        F.round(F.col("value") * 60).cast("bigint"))
    return ev.withColumn("secs", secs).withColumn(
        "dropoff", F.timestamp_add("SECOND", F.col("secs"), F.col("ts")))


def _flag(bit: int):
    return F.when((F.col("event_id") % 16).bitwiseAND(bit) != 0, "Y").otherwise("N")


def _base(c, n: int):
    return F.concat(F.lit("B"), F.lpad((c % n + 1).cast("string"), 5, "0"))


def event_trips(spark: SparkSession, sf_dir: str, feed: str = "yellow") -> DataFrame:
    """One raw month of ``feed`` built from ``events`` (one trip per event)."""
    ev = _events(spark, sf_dir)
    e, u, v = F.col("event_id"), F.col("user_id"), F.col("value")
    pu = (u % 265 + 1).cast("bigint")
    do = (e % 265 + 1).cast("bigint")
    tip = F.when(e % 3 == 0, 1.0).otherwise(0.0)
    if feed == "highvol":
        return ev.select(
            F.concat(F.lit("HV000"), (e % 5 + 2).cast("string")).alias("hvfhs_license_num"),
            _base(u, 120).alias("dispatching_base_num"), _base(e, 100).alias("originating_base_num"),
            F.col("ts").alias("request_datetime"), F.col("ts").alias("on_scene_datetime"),
            F.col("ts").alias("pickup_datetime"), F.col("dropoff").alias("dropoff_datetime"),
            pu.alias("PULocationID"), do.alias("DOLocationID"), v.alias("trip_miles"),
            F.col("secs").alias("trip_time"), v.alias("base_passenger_fare"),
            F.lit(0.0).alias("tolls"), F.lit(0.25).alias("bcf"), F.lit(0.5).alias("sales_tax"),
            F.lit(2.75).alias("congestion_surcharge"), F.lit(0.0).alias("airport_fee"),
            tip.alias("tip_amount"), v.alias("driver_pay"),
            _flag(8).alias("shared_request_flag"), _flag(4).alias("shared_match_flag"),
            F.lit("N").alias("access_a_ride_flag"), _flag(2).alias("wav_request_flag"),
            _flag(1).alias("wav_match_flag"))
    total = (F.when(e % 97 == 0, F.lit(None).cast("double"))
             .when(F.col("event_type") == "error", -v).otherwise(v + 1.3))
    passengers = F.when(e % 11 == 0, F.lit(None).cast("double")).otherwise((e % 7).cast("double"))
    common = dict(
        VendorID=(u % 2 + 1).cast("bigint"), passenger_count=passengers, trip_distance=v,
        RatecodeID=(e % 7 + 1).cast("double"), store_and_fwd_flag=F.lit("N"),
        PULocationID=pu, DOLocationID=do, fare_amount=v, extra=F.lit(0.5),
        mta_tax=F.lit(0.5), tip_amount=tip, tolls_amount=F.lit(0.0),
        improvement_surcharge=F.lit(0.3), total_amount=total,
        congestion_surcharge=F.lit(2.5))
    if feed == "yellow":
        cols = dict(tpep_pickup_datetime=F.col("ts"), tpep_dropoff_datetime=F.col("dropoff"),
                    **common, payment_type=(e % 7).cast("bigint"), airport_fee=F.lit(0.0))
        order = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
                 "trip_distance", "RatecodeID", "store_and_fwd_flag", "PULocationID",
                 "DOLocationID", "payment_type", "fare_amount", "extra", "mta_tax",
                 "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
                 "congestion_surcharge", "airport_fee"]
    elif feed == "green":
        trip_type = F.when(e % 13 == 0, F.lit(None).cast("double")).otherwise((e % 3).cast("double"))
        cols = dict(lpep_pickup_datetime=F.col("ts"), lpep_dropoff_datetime=F.col("dropoff"),
                    **common, ehail_fee=F.lit(None).cast("double"),
                    payment_type=(e % 7).cast("double"), trip_type=trip_type)
        order = ["VendorID", "lpep_pickup_datetime", "lpep_dropoff_datetime",
                 "store_and_fwd_flag", "RatecodeID", "PULocationID", "DOLocationID",
                 "passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax",
                 "tip_amount", "tolls_amount", "ehail_fee", "improvement_surcharge",
                 "total_amount", "payment_type", "trip_type", "congestion_surcharge"]
    else:
        raise ValueError(f"unknown feed {feed!r}")
    return ev.select(*[cols[c].alias(c) for c in order])


def _dec(c, p, s=2):
    return F.col(c).cast(f"decimal({p},{s})") if isinstance(c, str) else c.cast(f"decimal({p},{s})")


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One narrow row per line item of what its trip is made of, and the month of
    its order (``order_month``), by which rows are dealt before they grow."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # orders ⋈ customer and lineitem ⋈ supplier first: joined later, lineitem-sized
    # rows would be shuffled again by customer or supplier key where these are not
    # broadcast. (Catalyst keeps the written order without CBO.)
    prio = F.substring("o_orderpriority", 1, 1)
    oc = join_lookup(orders, cust, orders.o_custkey == cust.c_custkey).select(
        "o_orderkey", "o_orderdate", F.col("c_nationkey").cast("int").alias("pu_location_id"),
        F.when(prio.isin("1", "2", "3", "4"), prio.cast("int")).otherwise(0).alias("payment_id"))
    ls = join_lookup(li, supp, li.l_suppkey == supp.s_suppkey).select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        (F.col("l_suppkey") % 2 + 1).cast("int").alias("vendor_id"),
        F.col("s_nationkey").cast("int").alias("do_location_id"),
        F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "R", 2)
         .when(F.col("l_returnflag") == "N", 3).alias("trip_type_id"))
    ls, oc = dealt(ls, "l_orderkey", oc, "o_orderkey", li.count())
    return ls.join(oc, ls.l_orderkey == oc.o_orderkey).select(
        F.trunc("o_orderdate", "month").alias("order_month"), "o_orderdate", "l_partkey",
        "l_quantity", _dec("l_extendedprice", 12).alias("fare_amount"), _dec("l_tax", 4).alias("tax"),
        _dec("l_discount", 4).alias("discount"), "vendor_id", "pu_location_id", "do_location_id",
        "payment_id", "trip_type_id")


def order_trips(spark: SparkSession, sf_dir: str, by_month: bool = False) -> DataFrame:
    """Trip-shaped rows, one per line item, money as exact decimals. ``by_month``
    deals the narrow rows by their file month first, for a write by month."""
    j = order_rows(spark, sf_dir)
    if by_month:
        j = rebalanced(j, "order_month")
    minute, fare, tax = F.col("l_partkey") % 1440, F.col("fare_amount"), F.col("tax")
    return j.select(
        F.timestamp_add("MINUTE", minute, F.col("o_orderdate")).alias("pickup_datetime"),
        F.timestamp_add("MINUTE", minute + F.col("l_quantity").cast("bigint"),
                        F.col("o_orderdate")).alias("dropoff_datetime"),
        _dec("l_quantity", 9).alias("trip_distance"),
        fare.alias("fare_amount"),
        (fare * tax).cast("decimal(18,2)").alias("tip_amount"),
        (fare * (1 - F.col("discount")) * (1 + tax)).cast("decimal(18,2)").alias("total_amount"),
        "vendor_id",
        (F.col("l_partkey") % 7 + 1).cast("int").alias("rate_code_id"),
        "pu_location_id", "do_location_id", "payment_id", "trip_type_id",
        F.date_format("o_orderdate", "yyyy").alias("data_year"),
        F.date_format("o_orderdate", "MM").alias("data_month"),
    )


def order_trips_span(spark: SparkSession, sf_dir: str) -> tuple[dt.date, dt.date]:
    """Whole calendar years covering every ``order_trips`` pickup and
    dropoff: from the first order to the last one plus the latest minute of a
    day and the longest trip (one minute per unit of quantity). Three scalars."""
    longest = table(spark, sf_dir, "lineitem").agg(F.max("l_quantity")).first()[0] or 0
    row = table(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi")).first()
    hi = row["hi"] + dt.timedelta(days=1 + int((1439 + float(longest)) // 1440))
    return dt.date(row["lo"].year, 1, 1), dt.date(hi.year, 12, 31)


def order_trips_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The span of ``order_trips_span`` before it is widened to whole years, as
    one row ``(lo, hi)`` of a plan."""
    day = F.to_date("o_orderdate")
    some = table(spark, sf_dir, "orders").agg(F.min(day).alias("lo"), F.max(day).alias("last"),
                                              F.lit(None).cast("double").alias("longest"))
    line = table(spark, sf_dir, "lineitem").agg(F.lit(None).cast("date").alias("lo"), F.lit(None).cast("date").alias("last"),
                                                F.max("l_quantity").cast("double").alias("longest"))
    ends = some.union(line).agg(*(f(c).alias(c) for f, c in ((F.min, "lo"), (F.max, "last"), (F.max, "longest"))))
    more = F.floor((1439 + F.coalesce("longest", F.lit(0.0))) / 1440).cast("int") + 1
    return ends.select("lo", F.date_add("last", more).alias("hi"))


def order_trip_parts(trips: DataFrame) -> DataFrame:
    """Parts and minutes for ``order_trips`` rows (input of ``add_keys``)."""
    return trips.select("*", *trip_parts("pickup_datetime", "dropoff_datetime"),
                        trip_minutes("pickup_datetime", "dropoff_datetime").alias("trip_time"))


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("location_id"), F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.concat(F.lit("Z"), F.col("n_regionkey").cast("string")).alias("service_zone"))


def base_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base lookup from ``supplier``; every row appears twice (the raw lookup
    has duplicates the builder must remove)."""
    supp = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    one = supp.join(nation, supp.s_nationkey == nation.n_nationkey).select(
        F.concat(F.lit("B"), F.lpad(F.col("s_suppkey").cast("string"), 5, "0")).alias("license_no"),
        F.col("s_name").alias("entity_name"), F.col("n_name").alias("type_of_base"))
    return one.unionAll(one)


def landing_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(year, month, feed, path, bytes) of landed files, one per month and
    feed present in ``order_trips``: yellow for line status F, green
    otherwise; green files of months divisible by 5 are missing."""
    # Line items reduced to (order, status, count) before the join (map-side
    # partial aggregation): the join shuffles far fewer rows.
    li = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linestatus")
          .agg(F.count(F.lit(1)).alias("n")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(orders, li.l_orderkey == orders.o_orderkey)
    feed = F.when(F.col("l_linestatus") == "F", "yellow").otherwise("green")
    m = j.groupBy(F.date_format("o_orderdate", "yyyy").alias("year"),
                  F.date_format("o_orderdate", "MM").alias("month"),
                  feed.alias("feed")).agg(F.sum("n").alias("bytes"))
    m = m.filter(~((F.col("feed") == "green") & (F.col("month").cast("int") % 5 == 0)))
    path = F.concat_ws("", F.col("year"), F.lit("/"), F.col("month"), F.lit("/"), F.col("feed"),
                       F.lit("_tripdata_"), F.col("year"), F.lit("-"), F.col("month"))
    return m.select("year", "month", "feed", path.alias("path"), "bytes")
