"""Sharding by a hierarchical weighted hash tree.

The tree has regions, racks and shards. Every node draws for every row an
exponential time ``-ln(u) / weight`` from a hash of the row's id and the node's
name alone; the weight of a rack or region is the sum of those below it. A row
descends level by level: to the region with the least draw, among its racks to
the one with the least, among its shards likewise. The levels are independent,
so a row costs regions + racks + shards draws along its own path only.

A changed weight changes only the draws of the nodes above it. Rows move between
the children of a node only into a child whose weight rose (or out of one whose
weight fell); choices below untouched nodes stay as they were. A shard in a
region of its own therefore takes rows only into itself, and ``tree`` adds every
shard beyond the first ``built`` ones in this way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOT_ROWS = 50_000  # rows of a shard that are numbered together, on average
DRAW_BITS = 52


@dataclass(frozen=True)
class Shard:
    number: int
    region: int
    rack: int
    weight: float = 1.0


def tree(shards: int, regions: int = 2, racks: int = 3, built: int = 24) -> list[Shard]:
    """``shards`` equal shards. The first ``built`` are dealt out to
    ``regions * racks`` racks in turn; every later one opens a region of its own,
    so from ``built`` on one more shard takes rows only into itself. A tree of
    fewer shards is another tree, not an earlier state of a larger one."""
    return [Shard(i, i % regions, i // regions % racks) if i < built else Shard(i, regions + i - built, 0)
            for i in range(shards)]


def draw(key: Column, name: Column, weight: Column) -> Column:
    """The row's exponential draw for the node of the tree with this name."""
    text = F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(":"), name)
    number = F.conv(F.substring(F.md5(text.cast("binary")), 1, DRAW_BITS // 4), 16, 10).cast("double")
    return -F.log((number + 1) / float(1 << DRAW_BITS)) / weight


def _level(shards: list[Shard], depth: int = 0) -> Column:
    """The nodes under one parent as a constant array of (name, weight, below);
    ``below`` is the same array one level down, or a shard's number."""
    path = lambda s: (s.region, s.rack, s.number)[:depth + 1]
    nodes = []
    for at in sorted({path(s) for s in shards}):
        own = [s for s in shards if path(s) == at]
        nodes.append(F.struct(F.lit("/".join(map(str, at))).alias("name"),
                              F.lit(float(sum(s.weight for s in own))).alias("weight"),
                              (F.lit(own[0].number) if depth == 2 else _level(own, depth + 1)).alias("below")))
    return F.array(*nodes)


def descend(key: Column, shards: list[Shard]) -> Column:
    """The shard that the row reaches, as an int column. Shards without weight
    take no rows; equal draws go to the first node. A tree without weight is an error."""
    shards = [s for s in shards if s.weight > 0]
    if not shards:
        raise ValueError("no shard has a weight")
    at = _level(shards)
    for _ in range(3):
        at = F.array_min(F.transform(at, lambda n: F.struct(
            draw(key, n["name"], n["weight"]).alias("draw"), n["name"], n["below"])))["below"]
    return at


def shard(docs: DataFrame, shards: list[Shard], grown: list[Shard] | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``size`` (UTF-8 bytes and 8 more), ``text_crc32``, ``shard``
    and, with ``grown``, the shard in that tree.

    The shard depends on the id and the tree alone, so rows with equal ids go
    together. A null id counts as the word null; a null text has size 8 and the
    checksum 0 of no bytes. Columns named like an added one are replaced. No
    shuffle: each row is decided on its own.
    """
    text, key = F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.col(id_col)
    added = {"size": (F.octet_length(text) + 8).cast("long"), "text_crc32": F.crc32(text.cast("binary")),
             "shard": descend(key, shards).cast("int"),
             "grown_shard": (descend(key, grown) if grown else F.lit(None)).cast("int")}
    return docs.select(*(c for c in docs.columns if c not in added or c in (id_col, text_col)),
                       *(v.alias(k) for k, v in added.items()))


def slots(placed: DataFrame, shards: int, key: str, order: list[str]) -> DataFrame:
    """``placed`` with ``slot``: its rows numbered from 0 without gaps in every
    shard, by bucket of ``key``, then by ``order``.

    A shard is numbered in buckets of about ``SLOT_ROWS`` rows by hash, each by
    one window; the counts of the buckets (one number per bucket) say where each
    begins, so that no task has to order a whole shard. Rows equal in ``order``
    may swap places when the query runs again.
    """
    buckets = max(1, -(-placed.count() // (SLOT_ROWS * shards)))
    text = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit(":slot"))
    number = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")
    some = placed.withColumn("_bucket", (number % buckets).cast("int"))
    count = some.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = count.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("shard", "_bucket").orderBy(*order)
    return (some.withColumn("_row", F.row_number().over(within))
            .join(base, ["shard", "_bucket"])
            .withColumn("slot", (F.col("_base") + F.col("_row") - 1).cast("long"))
            .drop("_bucket", "_base", "_row"))


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder of Parquet files per shard; large shards in several files."""
    (placed.hint("rebalance", "shard").write.mode("overwrite")
     .option("maxRecordsPerFile", 1_000_000).partitionBy("shard").parquet(path))
