"""Additive summary of a fact, kept by the month load.

A row per file month, calendar month, payment and trip type holds the number of
trips and the sums of the dashboard's measures. File period and calendar month
differ (a trip lies in the file of another month), so the slice that a month
load replaces is the file month's, whatever calendar months its trips have. KPIs
over the summary equal those over the fact, at a handful of rows a month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.joins import join_dim
from .dims import Dims
from .metrics import MEASURES, ROLE_KEY
from .publish import load_month

KEYS = ["data_year", "data_month", "year", "month", "payment_id", "trip_type_id"]


def summarize(fact: DataFrame, role: str = "pickup") -> DataFrame:
    """One row per ``KEYS``: ``n_trips`` and the sum of every measure under the
    measure's own name. Calendar parts come from the padded date key of ``role``;
    a fact without a trip type (yellow) has null there."""
    key = F.col(ROLE_KEY[role])
    if "trip_type_id" not in fact.columns:
        fact = fact.withColumn("trip_type_id", F.lit(None).cast("int"))
    month = F.floor(key / 100)
    return (fact.withColumns({"year": F.floor(month / 100).cast("int"), "month": (month % 100).cast("int")})
            .groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_trips"),
                                *[F.sum(c).alias(c) for c in MEASURES.values()]))


def load_summary(summary: DataFrame, path: str, period=None) -> None:
    """Replace the file months of ``summary`` (or exactly ``period``, also by
    nothing) in the stored table."""
    load_month(summary, path, period)


def summary_view(summary: DataFrame, dims: Dims) -> DataFrame:
    """The summary as a star view for ``metrics``: calendar ``year`` and ``month``
    as they are, names of payment and trip type joined."""
    pay = dims.payment.select(F.col("payment_id").alias("__p"), "payment_type")
    kind = dims.triptype.select(F.col("triptypeid").alias("__t"), "trip_type")
    out = join_dim(summary, pay, F.col("payment_id") == F.col("__p"), "left", "payment" in dims.small)
    return join_dim(out, kind, F.col("trip_type_id") == F.col("__t"), "left", "triptype" in dims.small).drop("__p", "__t")
