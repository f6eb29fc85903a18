"""Dashboard metrics over a star view: period totals, year-over-year KPIs,
breakdowns, share of total, rollups.

Every metric is one ``groupBy().agg()`` with conditional sums, so a KPI set
for two periods is a single pass with map-side partial aggregation: a hot
group (one payment type holding a third of all trips) is pre-aggregated in
every task and never lands in one task as raw rows. Sums run on exact
decimals; ratios are computed in double from those exact sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import growth, key_range, pct_label, ratio
from ..period import month_number

# Dashboard KPI name -> fact column.
MEASURES = {"revenue": "total_amount", "fare": "fare_amount", "tip": "tip_amount",
            "distance": "trip_distance"}
ROLE_KEY = {"pickup": "pickup_date_id", "same_day": "pickup_date_id",
            "dropoff": "dropoff_date_id"}


def _measures(measures) -> dict[str, str]:
    if isinstance(measures, str):
        measures = [measures]
    return {m: MEASURES.get(m, m) for m in measures}


def _by(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def period_condition(year, month, years_back: int = 0) -> Column:
    """``year = y - years_back and month = m`` on the view's calendar columns."""
    y, m = int(year), month_number(month)
    return (F.col("year") == y - years_back) & (F.col("month") == m)


def in_period(view: DataFrame, year, month, role: str = "pickup") -> DataFrame:
    """Rows of the star view whose calendar year and month match. The same
    test is first written as a range on the fact's date key of ``role``, which
    reaches the Parquet scan; the calendar columns come from that key."""
    key = ROLE_KEY[role]
    if key in view.columns:
        lo, hi = key_range(int(year), month_number(month))
        view = view.filter(F.col(key).between(lo, hi))
    return view.filter(period_condition(year, month))


def _key_prefilter(view: DataFrame, year, month, role: str) -> DataFrame:
    """Superset filter on the fact's date key for the current and prior
    period. It is a plain range predicate on a fact column, so Catalyst moves
    it below the dimension joins and into the Parquet scan (row groups of
    other months are skipped). The exact calendar test still runs in the
    conditional sums."""
    key = ROLE_KEY[role]
    if key not in view.columns:
        return view
    y, m = int(year), month_number(month)
    cond = None
    for yy in (y, y - 1):
        lo, hi = key_range(yy, m)
        c = F.col(key).between(lo, hi)
        cond = c if cond is None else cond | c
    return view.filter(cond)


def period_totals(view: DataFrame, measures, year, month, by=(), role: str = "pickup",
                  prefilter: bool = True) -> DataFrame:
    """``cur_<m>`` = SUM(x) over the period, ``prev_<m>`` = the same month one
    year earlier (a CASE without ELSE: rows outside contribute null)."""
    ms, by = _measures(measures), _by(by)
    if prefilter:
        view = _key_prefilter(view, year, month, role)
    cur, prev = period_condition(year, month), period_condition(year, month, 1)
    aggs = []
    for name, col in ms.items():
        aggs += [F.sum(F.when(cur, F.col(col))).alias(f"cur_{name}"),
                 F.sum(F.when(prev, F.col(col))).alias(f"prev_{name}")]
    return view.groupBy(*by).agg(*aggs)


def yoy(view: DataFrame, measures, year, month, by=(), drop_null: bool = True,
        members: Sequence | None = None, labels: bool = False, role: str = "pickup",
        keep_totals: bool = False) -> DataFrame:
    """Year-over-year change ``(cur - prev) / prev`` per group.

    * ``drop_null`` keeps only groups with a non-null ratio of the first
      measure (the HAVING of the breakdown charts);
    * ``members`` restricts the first ``by`` column to the listed values (a
      ``None`` entry keeps the null group); ``members=None`` keeps all groups,
      null included;
    * ``labels`` adds ``<name>_label`` text such as ``-1.88%``.

    The key-range prefilter is applied when it cannot change the result: with
    no grouping, or when groups without data are dropped anyway.
    """
    ms, by = _measures(measures), _by(by)
    if members is not None and by:
        # None in ``members`` selects the null group (isin never matches null).
        named = [m for m in members if m is not None]
        keep = F.col(by[0]).isin(named) if named else F.lit(False)
        if any(m is None for m in members):
            keep = keep | F.col(by[0]).isNull()
        view = view.filter(keep)
    totals = period_totals(view, ms, year, month, by, role,
                           prefilter=drop_null or not by)
    cols = [F.col(b) for b in by]
    for name in ms:
        r = growth(f"cur_{name}", f"prev_{name}")
        cols.append(r.alias(f"yoy_{name}"))
        if labels:
            cols.append(pct_label(r).alias(f"yoy_{name}_label"))
        if keep_totals:
            cols += [F.col(f"cur_{name}").cast("double").alias(f"cur_{name}"),
                     F.col(f"prev_{name}").cast("double").alias(f"prev_{name}")]
    out = totals.select(*cols)
    if drop_null and by:
        out = out.filter(F.col(f"yoy_{next(iter(ms))}").isNotNull())
    return out


def kpi_all(view: DataFrame, year, month, role: str = "pickup", labels: bool = False) -> DataFrame:
    """The four dashboard KPIs (revenue, fare, tip, distance) in one pass."""
    return yoy(view, list(MEASURES), year, month, role=role, labels=labels)


def total_by(view: DataFrame, measure: str, by, rollup: bool = False) -> DataFrame:
    """``total_<m>`` = SUM(measure) per group (null group kept). With
    ``rollup`` the grand total is added; ``grouping_id`` = 1 marks it and
    tells it apart from a null member."""
    name, col = next(iter(_measures(measure).items()))
    agg = F.sum(col).alias(f"total_{name}")
    if rollup:
        return view.rollup(*_by(by)).agg(agg, F.grouping_id().cast("int").alias("grouping_id"))
    return view.groupBy(*_by(by)).agg(agg)


def share_of_total(view: DataFrame, measure: str, by) -> DataFrame:
    """Per group: ``total_<m>`` and ``share_<m>`` = its fraction of the sum
    over all groups. The grand total is a scalar subquery over the grouped
    result (a single row), so no window gathers the groups into one task."""
    name = next(iter(_measures(measure)))
    grouped = total_by(view, measure, by)
    grand = grouped.select(F.sum(f"total_{name}")).scalar()
    return grouped.withColumn(f"share_{name}", ratio(f"total_{name}", grand))


TILES = ("kpi", "payment_type", "trip_type")


def dashboard(view: DataFrame, year, month) -> DataFrame:
    """The whole dashboard in one aggregation over ``view`` (a star view with
    calendar, ``payment_type`` and ``trip_type``): grouping sets over (), payment
    and trip type. One row per ``tile`` and member:

    * ``kpi``: year-over-year revenue, fare, tip, distance and the total fare;
    * ``payment_type``: year-over-year revenue and fare, members where one of
      them is not null;
    * ``trip_type``: total fare and its share of all, whatever the period.

    No trips, no rows. ``grouping_id`` tells a tile from a null member. The share's total is a
    window over the grouped rows, one per member of two dimensions."""
    cur, prev = period_condition(year, month), period_condition(year, month, 1)
    aggs = [F.sum("fare_amount").alias("total"), F.grouping_id().alias("gid")]
    for name, col in MEASURES.items():
        aggs += [F.sum(F.when(cur, F.col(col))).alias(f"cur_{name}"),
                 F.sum(F.when(prev, F.col(col))).alias(f"prev_{name}")]
    sets = view.groupingSets([[], [F.col("payment_type")], [F.col("trip_type")]],
                             F.col("payment_type"), F.col("trip_type")).agg(*aggs)
    # Bits of grouping_id: payment_type, trip_type; 1 where a column is not in the set.
    tile = F.when(F.col("gid") == 3, TILES[0]).when(F.col("gid") == 1, TILES[1]).otherwise(TILES[2])
    at = lambda *tiles: F.col("tile").isin(*tiles)
    grand = F.max(F.when(at("kpi"), F.col("total"))).over(Window.partitionBy())
    growth_of = lambda name, *tiles: F.when(at(*tiles), growth(f"cur_{name}", f"prev_{name}")).alias(f"yoy_{name}")
    out = sets.withColumn("tile", tile).withColumn("grand", grand).select(
        "tile", F.coalesce("payment_type", "trip_type").alias("member"),
        growth_of("revenue", "kpi", "payment_type"), growth_of("fare", "kpi", "payment_type"),
        growth_of("tip", "kpi"), growth_of("distance", "kpi"),
        F.when(at("kpi", "trip_type"), F.col("total")).alias("total_fare"),
        F.when(at("trip_type"), ratio("total", "grand")).alias("share_fare"))
    return out.where(~at("payment_type") | F.col("yoy_revenue").isNotNull() | F.col("yoy_fare").isNotNull())


def star_rollup(view: DataFrame, by, fields: Sequence[str]) -> DataFrame:
    """Default aggregation per field: SUM for numbers, COUNT (non-null
    values) for everything else (text, dates, flags)."""
    types = {f.name: f.dataType for f in view.schema.fields}
    aggs = []
    for f in fields:
        if isinstance(types[f], T.NumericType):
            aggs.append(F.sum(f).alias(f"sum_{f}"))
        else:
            aggs.append(F.count(f).alias(f"count_{f}"))
    return view.groupBy(*_by(by)).agg(*aggs)
