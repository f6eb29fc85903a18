"""Dimension joins: broadcast only a side whose size bound is known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_dim(fact: DataFrame, dim: DataFrame, on: Column | list, how: str,
             small: bool) -> DataFrame:
    """Join a fact to a dimension.

    ``small`` must come from a checked bound (``Dims.small``): then the
    dimension is broadcast and the fact is never shuffled. Otherwise the plan
    is left to Catalyst and AQE, which fall back to a shuffle join and still
    switch to broadcast at runtime when the real size allows it.
    """
    return fact.join(F.broadcast(dim) if small else dim, on, how)


# Rows of a side, cut to a key and an attribute, that a join may broadcast (some
# 50 MB as a hash table), and rows of a side that one task of a shuffle join sorts.
BROADCAST_ROWS = 1_000_000
JOIN_ROWS = 500_000
MAX_DEALT = 200    # more partitions than this are the session's to ask for


def join_lookup(df: DataFrame, lookup: DataFrame, on: Column) -> DataFrame:
    """Inner join to a narrow table whose rows are counted first: up to
    ``BROADCAST_ROWS`` it is broadcast, whatever the estimate of its size says."""
    return join_dim(df, lookup, on, "inner", lookup.count() <= BROADCAST_ROWS)


def dealt(left: DataFrame, left_key: str, right: DataFrame, right_key: str, rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of a shuffle join, ``left`` of about so many ``rows``. Where the
    session's partitions would hold more than ``JOIN_ROWS`` of them each, both are
    dealt over more of them (AQE then splits no hot key)."""
    n = min(MAX_DEALT, -(-rows // JOIN_ROWS))
    if n <= int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return left, right
    return left.repartition(n, left_key), right.repartition(n, right_key)
