"""Connected components of a link table by minimum labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``edges (a, b)``: the smallest node
    reachable from it. Null ends and loops join nothing.

    Each round takes the smallest label among a node and its neighbours, then
    the label of that label, so paths shorten by more than half a round. Rounds
    are written to the shared folder; their inputs are plain scans, so a node
    with very many links is split by AQE's skew join and pre-aggregated by the
    partial minimum.
    """
    both = saved(edges.select(F.col("a").alias("x"), F.col("b").alias("y"))
                 .union(edges.select("b", "a")).where("x <> y"), "edges")
    labels = saved(both.groupBy(F.col("x").alias("node"))
                   .agg(F.min(F.least("x", "y")).alias("label")), "labels")
    total = None
    while True:
        near = both.join(labels, both.y == labels.node).select(F.col("x").alias("node"), "label")
        least = near.union(labels).groupBy("node").agg(F.min("label").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        labels = saved(least.join(up, "label").select("node", F.least("label", "above").alias("label")),
                       "labels")
        now = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if now == total:
            return labels
        total = now
