"""Plan shape: broadcast dimensions, pushed filters and pruned columns, no
join or shuffle in the fact build, one fact scan per audit, no window for
the share of total."""

import pytest

from tripmart.operators import audit, metrics
from tripmart.operators.facts import build_fact
from tripmart.operators.publish import to_layout
from tripmart.operators.star import star_view
from tripmart.period import Period
from tripmart.plans.registry import KPI_MONTH, KPI_YEAR
from tripmart.plans.tables import published_orders
from tripmart.sources.adapters import event_trips

from .conftest import SF001, SF01, plan_text


@pytest.fixture(scope="module")
def pub(spark):
    return published_orders(spark, SF01)


def test_fact_build_has_no_join_and_no_shuffle(spark, dims):
    f = build_fact(event_trips(spark, SF01, "yellow"), "yellow", Period("2024", "01"), dims)
    plan = plan_text(f, "simple")
    assert "Join" not in plan and "Exchange" not in plan
    assert "GreaterThanOrEqual(ts," in plan      # date-range membership pushed to the scan


def test_join_form_broadcasts_dims(spark, dims):
    f = build_fact(event_trips(spark, SF01, "yellow"), "yellow", Period("2024", "01"), dims,
                   how="join")
    plan = plan_text(f, "simple")
    assert plan.count("BroadcastHashJoin [") == 4 and "SortMergeJoin" not in plan


def test_star_view_broadcasts_bounded_dims(spark, pub):
    plan = plan_text(star_view(pub.fact, pub.dims, include=("date", "time", "payment", "vendor")),
                     "simple")
    assert plan.count("LeftOuter, BuildRight") == 4
    assert "SortMergeJoin" not in plan


def test_yoy_pushes_key_range_and_prunes_columns(spark, pub):
    v = star_view(pub.fact, pub.dims, include=("date", "payment"))
    plan = plan_text(metrics.yoy(v, "revenue", KPI_YEAR, KPI_MONTH, by="payment_type"))
    scan = plan[plan.index("Scan parquet"):]
    pushed = scan[scan.index("PushedFilters"):].split("\n")[0]
    assert "GreaterThanOrEqual(pickup_date_id,19971101)" in pushed
    schema = scan[scan.index("ReadSchema"):].split("\n")[0]
    assert schema == ("ReadSchema: struct<total_amount:decimal(18,2),payment_id:int,"
                      "pickup_date_id:int>")


def test_kpis_are_one_aggregation(spark, pub):
    plan = plan_text(metrics.kpi_all(star_view(pub.fact, pub.dims, include=("date",)),
                                     KPI_YEAR, KPI_MONTH), "simple")
    assert plan.count("FileScan parquet") == 1
    assert plan.count("Exchange SinglePartition") <= 1 and "Exchange hashpartitioning" not in plan


def test_share_uses_no_window(spark, pub):
    df = metrics.share_of_total(star_view(pub.fact, pub.dims, include=("triptype",)), "fare",
                                "trip_type")
    df.collect()
    plan = plan_text(df, "simple")
    assert "Window" not in plan
    # the grand-total subquery reads the grouped shuffle of the main query
    assert "ReusedExchange" in plan.split("== Initial Plan ==")[0] or "ReusedExchange" in plan


def test_fk_audit_scans_fact_once(spark, dims):
    f = to_layout(build_fact(event_trips(spark, SF01, "yellow"), "yellow", Period("2024", "01"),
                             dims), "yellow")
    df = audit.fk_audit(f, dims, "yellow")
    df.collect()
    plan = plan_text(df, "simple").split("== Initial Plan ==")[0]
    assert plan.count("events.parquet") == 1
    assert "Expand" in plan         # unpivot, then (fk, key) pre-aggregation


def test_hot_groups_are_pre_aggregated_before_the_shuffle(spark, pub, dims):
    # A payment type (or key) holding a third of all rows reaches the shuffle
    # as one partial row per task.
    v = star_view(pub.fact, pub.dims, include=("date", "payment"))
    plan = plan_text(metrics.yoy(v, "revenue", KPI_YEAR, KPI_MONTH, by="payment_type"), "simple")
    below = plan[plan.index("Exchange hashpartitioning(payment_type"):]
    assert "partial_sum" in below
    f = to_layout(build_fact(event_trips(spark, SF01, "yellow"), "yellow", Period("2024", "01"),
                             dims), "yellow")
    fk = plan_text(audit.fk_audit(f, dims, "yellow"), "simple")
    below = fk[fk.index("Exchange hashpartitioning(fk_column#"):]
    assert "partial_count" in below


def test_hot_month_is_written_by_several_tasks(spark, tmp_path):
    import os

    from pyspark.sql import functions as F

    from tripmart.plans.tables import write_partitioned
    # month 01 holds over a third of all rows
    n = 300_000
    month = F.when(F.col("id") % 3 == 0, F.lit("01")).otherwise(
        F.lpad(((F.col("id") % 11) + 2).cast("string"), 2, "0"))
    df = spark.range(n, numPartitions=8).select(
        F.lit("2024").alias("data_year"), month.alias("data_month"),
        (20240101 + F.col("id") % 28).cast("int").alias("pickup_date_id"),
        (F.col("id") * 7919 % 1000003).alias("payload"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
        write_partitioned(df, str(tmp_path / "t"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot = [f for f in os.listdir(tmp_path / "t" / "data_year=2024" / "data_month=01")
           if f.endswith(".parquet")]
    # AQE split the hot month's shuffle partition: several tasks wrote it
    assert len(hot) > 1
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == n and back.filter("data_month = '01'").count() == n // 3


def test_lookups_get_no_broadcast_hint(spark):
    from tripmart.operators.dims import build_dims
    from tripmart.sources.adapters import base_lookup, zone_lookup
    dims = build_dims(spark, zone=zone_lookup(spark, SF01), base=base_lookup(spark, SF01))
    assert "zone" not in dims.small and "base" not in dims.small


def test_fact_build_shuffles_narrow_rows_and_no_supplier(spark, monkeypatch):
    from tripmart.plans import joins
    from tripmart.plans.tables import build_order_fact, order_dims
    from tripmart.sources.adapters import order_trips
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")
        fact = build_order_fact(spark, SF001, order_dims(spark, SF001), by_month=True)
        plan = plan_text(fact, "simple")
        # Only orders and line items meet by shuffle; customer and supplier are counted and broadcast.
        assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 2
        # Rows are dealt by month before the trip's columns exist.
        dealt = plan.index("REBALANCE_PARTITIONS_BY_COL")
        assert "order_month" in plan[dealt - 200:dealt] and "decimal(18,2)" not in plan[dealt:]
        monkeypatch.setattr(joins, "BROADCAST_ROWS", 1)
        assert plan_text(order_trips(spark, SF001), "simple").count("SortMergeJoin") == 3
        want = sorted(map(tuple, fact.collect()), key=repr)
        # Few partitions for many rows: more of them.
        monkeypatch.setattr(joins, "JOIN_ROWS", 500)
        more = build_order_fact(spark, SF001, order_dims(spark, SF001))
        assert "REPARTITION_BY_NUM" in plan_text(more, "simple")
        assert sorted(map(tuple, more.collect()), key=repr) == want
    finally:
        spark.conf.set(key, old)
