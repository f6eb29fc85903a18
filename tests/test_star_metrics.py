"""Star view roles (J6-J12, D4), KPIs (A1-A9, F4, F5), breakdowns, share and
rollup (A10, A11, W1, A12), with metamorphic checks."""

import pytest
from pyspark.sql import functions as F

from tripmart.operators import metrics
from tripmart.operators.star import star_view
from tripmart.plans.registry import KPI_MONTH, KPI_YEAR
from tripmart.plans.tables import ORDER_FACT_SCHEMA, published_orders

from .conftest import SF01

EXPECTED = {  # SURVEY 7.2, sf0.01, November 1997
    "pickup": {None: 0.516261, "Credit card": -0.018809, "Cash": -0.292522,
               "No charge": -0.144160, "Dispute": -0.319876},
    "same_day": {None: 0.508903, "Credit card": -0.019708, "Cash": -0.305030,
                 "No charge": -0.139775, "Dispute": -0.324271},
}


@pytest.fixture(scope="module")
def pub(spark):
    return published_orders(spark, SF01)


@pytest.mark.parametrize("role", ["pickup", "same_day"])
def test_yoy_revenue_by_payment_matches_survey(spark, pub, role):
    v = star_view(pub.fact, pub.dims, role)
    got = {r.payment_type: r.yoy_revenue for r in
           metrics.yoy(v, "revenue", KPI_YEAR, KPI_MONTH, by="payment_type", role=role).collect()}
    assert got.keys() == EXPECTED[role].keys()
    for k, x in EXPECTED[role].items():
        assert got[k] == pytest.approx(x, abs=5e-7)


def test_star_view_keeps_every_fact_row(spark, pub):
    n = pub.fact.count()
    for role in ("pickup", "dropoff", "same_day"):
        assert star_view(pub.fact, pub.dims, role).count() == n


def test_same_day_nulls_midnight_crossings(spark, pub):
    v = star_view(pub.fact, pub.dims, "same_day", include=("date",))
    crossing = v.filter("pickup_date_id <> dropoff_date_id")
    assert crossing.count() == 781  # FIXTURES 3.2
    assert crossing.filter(F.col("year").isNotNull()).count() == 0
    p = star_view(pub.fact, pub.dims, "pickup", include=("date",))
    assert p.filter("pickup_date_id <> dropoff_date_id and year is not null").count() == 781


def test_null_payment_bucket_survives(spark, pub):
    v = star_view(pub.fact, pub.dims, include=("payment",))
    assert v.filter("payment_id = 0 and payment_type is null").count() > 0


def test_prefilter_does_not_change_kpis(spark, pub):
    v = star_view(pub.fact, pub.dims)
    a = metrics.period_totals(v, list(metrics.MEASURES), KPI_YEAR, KPI_MONTH, prefilter=True)
    b = metrics.period_totals(v, list(metrics.MEASURES), KPI_YEAR, KPI_MONTH, prefilter=False)
    assert a.collect() == b.collect()


def test_kpi_total_equals_sum_over_groups(spark, pub):
    v = star_view(pub.fact, pub.dims)
    total = metrics.period_totals(v, "revenue", KPI_YEAR, KPI_MONTH).first()
    groups = metrics.period_totals(v, "revenue", KPI_YEAR, KPI_MONTH, by="payment_type",
                                   prefilter=False).agg(F.sum("cur_revenue"), F.sum("prev_revenue")).first()
    assert (total.cur_revenue, total.prev_revenue) == (groups[0], groups[1])
    kpi = metrics.kpi_all(v, KPI_YEAR, KPI_MONTH).first()
    expect = (float(total.cur_revenue) - float(total.prev_revenue)) / float(total.prev_revenue)
    assert kpi.yoy_revenue == pytest.approx(expect, rel=1e-12)


def test_yoy_null_rules(spark):
    rows = [(2023, 11, "a", 10.0), (2022, 11, "a", 8.0),     # normal
            (2023, 11, "b", 5.0),                            # no prior year -> null
            (2023, 11, "c", 5.0), (2022, 11, "c", 0.0),      # prior year zero -> null
            (2022, 11, "d", 4.0),                            # no current -> null
            (2023, 11, None, 3.0), (2022, 11, None, 1.0)]    # null member kept
    v = spark.createDataFrame(rows, "year int, month int, payment_type string, total_amount double")
    kept = {r.payment_type: r.yoy_revenue for r in
            metrics.yoy(v, "revenue", 2023, "Nov", by="payment_type").collect()}
    assert kept == {"a": pytest.approx(0.25), None: pytest.approx(2.0)}
    all_groups = metrics.yoy(v, "revenue", 2023, 11, by="payment_type", drop_null=False)
    assert all_groups.count() == 5
    only_a = metrics.yoy(v, "revenue", 2023, 11, by="payment_type", members=["a", "b"])
    assert [r.payment_type for r in only_a.collect()] == ["a"]
    with_null = metrics.yoy(v, "revenue", 2023, 11, by="payment_type", members=["a", None])
    assert sorted(str(r.payment_type) for r in with_null.collect()) == ["None", "a"]


def test_labels(spark, pub):
    v = star_view(pub.fact, pub.dims)
    r = metrics.yoy(v, "revenue", KPI_YEAR, KPI_MONTH, by="payment_type", labels=True) \
        .filter("payment_type = 'Credit card'").first()
    assert r.yoy_revenue_label == "-1.88%"


def test_fare_share_and_rollup(spark, pub):
    v = star_view(pub.fact, pub.dims)
    share = metrics.share_of_total(v, "fare", "trip_type").collect()
    assert sum(r.share_fare for r in share) == pytest.approx(1.0, abs=1e-12)
    by_name = {r.trip_type: round(r.share_fare, 6) for r in share}
    # FIXTURES 3.2: trip type ids 1/2/3 -> Street Hail / Dispatch / no dimension row
    assert by_name == {"Street Hail": 0.333432, "Dispatch": 0.334828, None: 0.33174}
    roll = metrics.total_by(v, "fare", "trip_type", rollup=True).collect()
    grand = [r for r in roll if r.grouping_id == 1]
    members = [r for r in roll if r.grouping_id == 0]
    assert len(grand) == 1 and len(members) == 3
    assert grand[0].total_fare == sum(r.total_fare for r in members)
    assert float(grand[0].total_fare) == pytest.approx(3183256271.63)


def test_star_rollup_default_aggregations(spark, pub):
    v = star_view(pub.fact, pub.dims)
    out = metrics.star_rollup(v, "vendor", ["fare_amount", "zone", "full_date"])
    assert set(out.columns) == {"vendor", "sum_fare_amount", "count_zone", "count_full_date"}
    assert out.agg(F.sum("sum_fare_amount")).first()[0] == pub.fact.agg(F.sum("fare_amount")).first()[0]


def test_published_fact_partition_columns_are_strings(spark, pub):
    assert [f.name for f in pub.fact.schema.fields] == [f.name for f in ORDER_FACT_SCHEMA.fields]
    assert pub.fact.select("data_month").first()[0].__class__ is str
    assert pub.fact.filter("data_month = '01'").count() > 0


@pytest.mark.parametrize("role", ["dropoff", "same_day"])
def test_prefilter_is_exact_for_every_role(spark, pub, role):
    v = star_view(pub.fact, pub.dims, role, include=("date", "payment"))
    a = metrics.period_totals(v, "revenue", KPI_YEAR, KPI_MONTH, by="payment_type", role=role,
                              prefilter=True)
    b = metrics.period_totals(v, "revenue", KPI_YEAR, KPI_MONTH, by="payment_type", role=role,
                              prefilter=False).filter("cur_revenue is not null or prev_revenue is not null")
    key = lambda r: repr(r)
    assert sorted(a.collect(), key=key) == sorted(b.collect(), key=key)
    rows = metrics.in_period(v, KPI_YEAR, KPI_MONTH, role=role).count()
    assert rows == v.filter(f"year = {KPI_YEAR} and month = 11").count()


def test_two_roles_in_one_view(spark, pub):
    zone = {a: f"pickup_{a}" for a in ("borough", "zone", "service_zone")}
    v = star_view(pub.fact, pub.dims, "pickup", include=("zone",), names=zone)
    v = star_view(v, pub.dims, "dropoff", include=("zone",),
                  names={a: f"dropoff_{a}" for a in ("borough", "zone", "service_zone")})
    assert v.count() == pub.fact.count()
    same = v.filter("pu_location_id = do_location_id")
    assert same.filter("pickup_zone <> dropoff_zone").count() == 0
    assert v.filter("pickup_zone is null or dropoff_zone is null").count() == 0
