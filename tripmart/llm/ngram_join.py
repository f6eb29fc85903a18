"""N-gram Jaccard join through count vectors and R-trees.

A document is the set of its k-word shingles. Shingles are hashed into groups
and a document is the point of its group counts, so the overlap of two
documents is at most the sum of their coordinate minima. That bound is used
three times:

1. *Routing.* Sum of minima >= needed overlap means: the counts differ by at
   most ``tau`` in all. Cut the groups of a size class into ``m > tau`` cells;
   linked documents agree exactly on all but ``tau`` cells at most, hence on
   at least one. Each document enters its cells of its own size class and of
   the smaller classes that it can link to; documents meet in cells only.
2. *R-tree.* Within a cell the points go into an R-tree (packed by sorting, a
   node keeps the largest and smallest count per coordinate); a query skips a
   node when the summed minima against its upper corner miss the overlap that
   its smallest size would need.
3. *Verification.* Surviving pairs compare their whole shingle sets.

Components need no list of all pairs. Documents with equal sets are one class
from the start. Of near copies the text that the others were made from has the
most members in its cells; each member of a cell is first verified against that
one alone. Cells whose members are then still in different components run
their R-trees, across components only, and a pair that the tree lets through
must pass the bound once more with its fine points (64 groups and more per
shingle), so that texts that are almost similar enough do not become pairs. A
pair of linked documents is thus either verified or already connected.

Cells agreeing on few shingles say little, so cells with fewer than two
shingles are skipped whenever enough others remain (``_cell_keys``); no
document or link is lost by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U, lists, mapped, maybe_in, mix, saved, shared_keys, shingle_hashes, signed, texts
from .components import components

RATIO = 1.6           # size classes grow by this factor
SLACK = 0.12          # more cells than needed, so that poor cells can be skipped
CELL_ROWS = 4_000     # a cell of more rows is dealt out in blocks
LEAF = 16             # points of an R-tree leaf
FINE = 4_096          # shingles of a set that has a fine point, at most


def classes(top: int = 1 << 40) -> np.ndarray:
    """Lower bounds of the size classes."""
    out = [1]
    while out[-1] < top:
        out.append(max(out[-1] + 1, int(out[-1] * RATIO)))
    return np.array(out)


_CLASSES = classes()


def _cells(c: int, num: int, den: int) -> tuple[int, int]:
    """The largest difference of linked documents whose smaller one is in class
    ``c``, and the number of cells."""
    tau = int(_CLASSES[c + 1] - 1) * (den - num) // num
    return tau, tau + 1 + int(tau * SLACK)


def _cell_keys(s: np.ndarray, num: int, den: int, edges: dict) -> np.ndarray:
    """Cell keys of one sorted shingle set.

    A document that differs from any partner in ``sd`` shingles at most agrees
    with it on ``m - sd`` cells or more. If fewer of its cells than that are
    poor (under two shingles), one of the agreed cells is rich; rich cells are
    always entered, so poor ones can go. Otherwise it enters every cell, and so
    does any partner in the same position.
    """
    n, out = len(s), []
    c = int(np.searchsorted(_CLASSES, n, "right")) - 1
    sums = np.concatenate([np.zeros(1, U), np.cumsum(s, dtype=U)])
    while c >= 0 and n * num <= int(_CLASSES[c + 1] - 1) * den:
        tau, m = _cells(c, num, den)
        if c not in edges:
            step = ((1 << 64) - 1) // m
            edges[c] = (np.arange(1, m, dtype=U) * U(step), mix((U(c) << U(40)) + np.arange(m, dtype=U)))
        inner, names = edges[c]
        at = np.concatenate([[0], np.searchsorted(s, inner), [n]])
        size = np.diff(at)
        keys = mix((sums[at[1:]] - sums[at[:-1]]) + names)
        if (size < 2).sum() < m - min(tau, n * (den - num) // num):
            keys = keys[size >= 2]
        out.append(keys)
        c -= 1
    return np.concatenate(out)


def _coarse(s: np.ndarray) -> bytes:
    """The set's point for comparing two documents: counts of about a quarter as
    many groups as shingles, a power of two. Two counts share a byte if all are
    below 16 (an odd length marks it), else each has its own. Empty if a count is
    too large for that, which stands for a point that overlaps with anything."""
    groups = 1 << max(5, (len(s) // 3).bit_length() - 1)
    c = np.bincount((s % U(groups)).astype(np.int64), minlength=groups)
    if c.max() < 16:
        return (c[::2] | c[1::2] << 4).astype(np.uint8).tobytes() + b"\0"
    return c.astype(np.uint8).tobytes() if c.max() < 256 else b""


def _fine(s: np.ndarray) -> bytes:
    """The set's fine point: the groups of its shingles when there are 64 to 128
    times as many groups as shingles, as steps of a byte each (255: go on), after
    a byte with the number of bits. Empty for none and for more than ``FINE``."""
    n = len(s)
    if not 0 < n <= FINE:
        return b""
    bits = 6 + n.bit_length()
    step = np.diff((s >> U(64 - bits)).astype(np.int64), prepend=0)
    many = step // 255 + 1
    out = np.full(many.sum(), 255, np.uint8)
    out[np.cumsum(many) - 1] = step % 255
    return bytes([bits]) + out.tobytes()


def _groups(fine: bytes) -> tuple[int, np.ndarray]:
    """The bits and the sorted groups of a fine point."""
    step = np.frombuffer(fine, np.uint8, offset=1)
    return fine[0], np.cumsum(step, dtype=np.int64)[step < 255]


def _shared_groups(x: tuple[int, np.ndarray], y: tuple[int, np.ndarray]) -> int:
    """Shingles of one set whose group the other has too: no overlap is larger."""
    bits = min(x[0], y[0])
    a, b = x[1] >> (x[0] - bits), y[1] >> (y[0] - bits)
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def _counts(point: bytes) -> np.ndarray:
    """The counts of a point."""
    c = np.frombuffer(point, np.uint8)
    return np.stack([c[:-1] & 15, c[:-1] >> 4], 1).ravel() if len(c) % 2 else c


def _sets(batch: pa.RecordBatch, text_col: int, k: int) -> Iterator[np.ndarray]:
    for t in texts(batch.column(text_col), lower=True):
        h, doc = shingle_hashes(t, k)
        at = t.bounds(doc)
        for d in range(len(t)):
            yield np.unique(h[at[d]:at[d + 1]])


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """``(doc_id, shingles)``: sorted distinct shingle hashes of whole texts."""
    def run(batches):
        for batch in batches:
            sets = list(_sets(batch, 1, k))
            at = np.cumsum([0] + [len(s) for s in sets])
            flat = np.concatenate(sets) if sets else np.empty(0, U)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists(flat.view(np.int64), at)], ["doc_id", "shingles"])
    return mapped(docs.select(F.col(id_col).cast("long"), text_col), run,
                  "doc_id long, shingles array<long>")


def _profiles(docs: DataFrame, id_col: str, text_col: str, k: int, num: int, den: int) -> DataFrame:
    """``(doc_id, n, d1, d2, cells, counts, fine)``: set size, 128-bit digest of
    the set, its cells and its coarse and fine point."""
    def run(batches):
        edges: dict = {}
        for batch in batches:
            n, d1, d2, cells, counts, fine = [], [], [], [], [], []
            for s in _sets(batch, 1, k):
                n.append(len(s))
                d1.append(int(s.sum(dtype=U)))
                d2.append(int(mix(s ^ U(0x5851F42D4C957F2D)).sum(dtype=U)))
                cells.append(_cell_keys(s, num, den, edges) if len(s) else s)
                counts.append(_coarse(s))
                fine.append(_fine(s))
            at = np.cumsum([0] + [len(c) for c in cells])
            flat = np.concatenate(cells) if cells else np.empty(0, U)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), signed(np.array(d1, U)),
                 signed(np.array(d2, U)), lists(flat.view(np.int64), at), pa.array(counts, pa.binary()),
                 pa.array(fine, pa.binary())],
                ["doc_id", "n", "d1", "d2", "cells", "counts", "fine"])
    return mapped(docs.select(F.col(id_col).cast("long"), text_col), run,
                  "doc_id long, n long, d1 long, d2 long, cells array<long>, counts binary, fine binary")


class RTree:
    """Packed R-tree of count vectors."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        # Points are packed in order of size, then of their coarse direction.
        coarse = points.reshape(len(points), 8, -1).sum(2)
        self.order = np.lexsort((*coarse.T, sizes))
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.levels = []  # from the leaves up: upper corners, least and largest size
        top, low, high = self.points, self.sizes, self.sizes
        while len(top) > 1:
            cut = np.arange(0, len(top), LEAF)
            top = np.maximum.reduceat(top, cut)
            low, high = np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)
            self.levels.append((top, low, high))

    def search(self, q: np.ndarray, n: int, num: int, den: int) -> np.ndarray:
        """Numbers of the points whose summed minima with ``q`` reach the overlap
        that a link needs."""
        found = np.arange(len(self.levels[-1][0]) if self.levels else len(self.points))
        for depth in range(len(self.levels) - 1, -2, -1):
            top, low, high = self.levels[depth] if depth >= 0 else (self.points, self.sizes, self.sizes)
            found = found[found < len(top)]
            reach = _reach(top[found], q)
            # overlap * (den + num) >= num * (n + size), for sizes of num/den apart at most
            ok = (reach * (den + num) >= num * (n + low[found])) & \
                (low[found] * num <= n * den) & (high[found] * den >= n * num)
            found = found[ok]
            if depth >= 0:
                found = (found[:, None] * LEAF + np.arange(LEAF)).ravel()
        return self.order[found]


def _reach(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Summed coordinate minima: no overlap is larger."""
    return np.minimum(x, y).sum(-1, dtype=np.int64)


def _bounded(num: int, den: int):
    """The pairs whose points can overlap enough."""
    def reach(x: bytes, y: bytes, n: int) -> int:
        if not x or not y:
            return n
        x, y = _counts(x), _counts(y)
        if len(x) > len(y):
            x, y = y, x
        if len(x) < len(y):  # groups of the longer one that fall into one of the shorter
            y = y.reshape(-1, len(x)).sum(0, dtype=np.int64)
        return int(np.minimum(x, y).sum(dtype=np.int64))

    def run(batches):
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            x, y = (batch.column(c).to_pylist() for c in ("counts_a", "counts_b"))
            most = np.array([reach(*v) for v in zip(x, y, (n + m).tolist())], np.int64)
            ok = (most * (den + num) >= num * (n + m)) & (n * den >= m * num) & (m * den >= n * num)
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


def _points(counts: list[bytes]) -> np.ndarray:
    """Coarse points as rows of one width, that of the shortest."""
    each = [_counts(c) for c in counts]
    width = min((len(c) for c in each if len(c)), default=32)
    out = np.full((len(counts), width), 65535, np.uint16)
    for i, c in enumerate(each):
        if len(c):
            out[i] = c.reshape(-1, width).sum(0, dtype=np.uint16)
    return out


def _tree_pairs(num: int, den: int, width: int):
    """Over rows ``(cell, lo, hi, block, doc, label, n, counts, fine, before)``
    sorted by cell: pairs of different labels that pass the bounds of the R-tree
    and of their fine points, which leave few but the links. ``before`` holds the
    numbers of the document's cells before this one, ``width`` bytes each, so a
    pair comes from its first cell only."""
    def of(cell: pa.Table) -> list[tuple[int, int]]:
        doc, label, block, n = (cell[c].to_numpy() for c in ("doc", "label", "block", "n"))
        if (label == label[0]).all():
            return []
        points = _points(cell["counts"].to_pylist())
        own = [frozenset(x[i:i + width] for i in range(0, len(x), width)) for x in cell["before"].to_pylist()]
        fine = [_groups(x) if x else None for x in cell["fine"].to_pylist()]
        tree, apart, out = RTree(points, n), cell["lo"][0].as_py() != cell["hi"][0].as_py(), []

        def reaches(i: int, k: int) -> bool:
            if fine[i] is None or fine[k] is None:
                return True
            return _shared_groups(fine[i], fine[k]) * (den + num) >= num * int(n[i] + n[k])

        for i in range(len(doc)):
            j = tree.search(points[i], int(n[i]), num, den)
            j = j[(doc[j] > doc[i]) & (label[j] != label[i])]
            for k in j[block[j] != block[i]] if apart else j:
                if own[i].isdisjoint(own[k]) and reaches(i, k):
                    out.append((int(doc[i]), int(doc[k])))
        return out

    def run(batches):
        held = None
        for batch in _and_end(batches):
            table = pa.Table.from_batches([batch]) if batch is not None else None
            if held is not None:
                table = pa.concat_tables([held, table]) if table is not None else held
            if table is None or not table.num_rows:
                continue
            ids = [table[c].to_numpy() for c in ("cell", "lo", "hi")]
            new = np.ones(table.num_rows, bool)
            new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in ids])
            at = np.append(np.flatnonzero(new), table.num_rows)
            last = len(at) - 1 if batch is None else len(at) - 2
            out = [x for i in range(last) for x in of(table.slice(at[i], at[i + 1] - at[i]))]
            held = None if batch is None else table.slice(at[last])
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])
    return run


def _and_end(batches):
    yield from batches
    yield None


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs ``(a, b)`` whose whole sets reach the similarity."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y")).cast("long")
    return (pairs.join(right, "b").join(left, "a")
            .where(both * den >= (F.size("x") + F.size("y") - both) * num).select("a", "b"))


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
               k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard similarity of
    ``num / den`` at least: one row ``(doc_id, n_shingles, component_id)`` per
    row of ``docs``; ``component_id`` is the smallest id reachable.

    Texts are lower-cased (A-Z) and cut at ASCII white space; a text of fewer
    than ``k`` words is one shingle; a null, empty or blank text has none and
    is alone. Rows with equal ids and different texts link as the texts do and
    share the id. A null id gets a null component. Other columns are ignored.

    The big shuffle is that of the cell entries (about 0.3 numbers per word);
    texts are not shuffled, and shingle sets only of documents in surviving pairs. A cell that holds a
    large part of all documents is combined per batch before the shuffle, its
    other rows are dealt out by document, and the R-tree stage deals cells of
    more than ``CELL_ROWS`` in blocks, so no task needs a whole cell.
    """
    if not 0 < num <= den:
        raise ValueError("the similarity must lie in (0, 1]")
    prof = saved(_profiles(docs, id_col, text_col, k, num, den), "profiles")
    # Equal sets are one class; only the row with its smallest id is joined, the
    # other ids are linked to that one.
    digest = ["n", "d1", "d2"]
    some = prof.where("n > 0 and doc_id is not null").select("doc_id", *digest)
    alike = saved(some.groupBy(*digest).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
                  .where("copies > 1"), "classes")
    member = saved(some.join(alike, digest).where("doc_id <> rep")
                   .select("doc_id", *digest, "rep").distinct(), "members")
    apart, near = maybe_in(prof.where("n > 0 and doc_id is not null").select("doc_id", *digest, "cells"),
                           F.col("doc_id"), member.select("doc_id"))
    reps = apart.union(near.join(member.select("doc_id", *digest), ["doc_id", *digest], "left_anti")
                       .select(*apart.columns))
    cells = saved(shared_keys(reps.select("doc_id", "cells")), "cells")

    # Every member of a cell against the one whose cells have the most members.
    # Of near copies that is the text the others were made from: it has none of
    # their changes, so all its cells are common ones.
    sized = saved(cells.select("key", "doc").distinct().join(
        cells.groupBy("key").agg(F.count_distinct("doc").alias("rows")).where("rows > 1"), "key"), "sized")

    def heads(rows: DataFrame) -> DataFrame:
        weight = rows.groupBy("doc").agg(F.sum("rows").alias("weight"))
        return (rows.join(weight, "doc").groupBy("key").agg(F.max(F.struct("weight", -F.col("doc"))).alias("head"))
                .select("key", (-F.col("head.col2")).alias("head")))

    star = sized.join(heads(sized), "key").where("doc <> head").select(
        F.least("head", "doc").alias("a"), F.greatest("head", "doc").alias("b"))
    points = prof.where("n > 0 and doc_id is not null").select("doc_id", "n", "counts")
    end = lambda c: points.toDF(c, f"n_{c}", f"counts_{c}")
    pairs = saved(mapped(star.distinct().join(end("a"), "a").join(end("b"), "b"),
                         _bounded(num, den), "a long, b long").distinct(), "pairs")
    wide = sized.where("rows > 2").select("key", "doc")
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def linked(some: DataFrame) -> DataFrame:
        inside = saved(some.select(F.col("a").alias("doc_id")).union(some.select("b")).distinct(), "inside")
        _, rows = maybe_in(text, F.col("doc_id"), inside)
        return _verified(some, saved(shingle_sets(rows, "doc_id", "text", k), "sets"), num, den)

    links = linked(pairs).union(member.select("rep", "doc_id"))
    label = components(links)

    # Large cells whose members are in different components so far.
    named = saved(wide.join(label.select(F.col("node").alias("doc"), "label"), "doc", "left")
                  .select("key", "doc", F.coalesce("label", "doc").alias("label")), "named")
    open_ = saved(named.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"),
                                           F.ceil(F.count("*") / CELL_ROWS).cast("long").alias("s"))
                  .where("x <> y").select("key", "s", F.monotonically_increasing_id().alias("cell")), "open")
    # Short numbers for them, as long lists of them travel: place * tasks + task.
    task, place = F.shiftright("cell", 33), F.col("cell").bitwiseAND((1 << 33) - 1)
    tasks = (open_.agg(F.max(task)).first()[0] or 0) + 1
    open_ = open_.withColumn("cell", place * tasks + task)
    opened = saved(named.join(open_, "key").drop("key"), "opened")
    width = max(1, (open_.agg(F.max("cell")).first()[0] or 0).bit_length() + 7 >> 3)
    number = lambda c: F.lpad(F.hex(c), 2 * width, "0")
    about = prof.where("n > 0 and doc_id is not null").select(F.col("doc_id").alias("doc"), "n", "counts", "fine").join(
        opened.groupBy("doc").agg(F.collect_set("cell").alias("cells")), "doc")
    dealt = (opened.withColumn("block", F.pmod(F.xxhash64("doc"), F.col("s")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("s") - 1)))
             .select("cell", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                     "block", "doc", "label"))
    before = F.transform(F.filter("cells", lambda c: c < F.col("cell")), number)
    cellwise = (dealt.join(saved(about, "about"), "doc")
                .select("cell", "lo", "hi", "block", "doc", "label", "n", "counts", "fine",
                        F.unhex(F.array_join(before, "")).alias("before"))
                .repartition("cell", "lo", "hi").sortWithinPartitions("cell", "lo", "hi"))
    across = saved(mapped(cellwise, _tree_pairs(num, den, width), "a long, b long").distinct()
                   .join(pairs, ["a", "b"], "left_anti"), "across")
    more = linked(across)
    name = label.select(F.col("node").alias("doc"), "label")
    up = lambda c: F.coalesce(F.col(f"{c}_label"), F.col(c)).alias(c)
    more = (more.join(name.select(F.col("doc").alias("a"), F.col("label").alias("a_label")), "a", "left")
            .join(name.select(F.col("doc").alias("b"), F.col("label").alias("b_label")), "b", "left")
            .select(up("a"), up("b")))
    merged = components(more).select(F.col("node").alias("label"), F.col("label").alias("over"))
    final = (label.select(F.col("node").alias("doc"), "label")
             .union(merged.select("label", "label")).distinct().join(merged, "label", "left")
             .groupBy("doc").agg(F.min(F.coalesce("over", "label")).alias("component")))
    return (prof.select("doc_id", F.col("n").alias("n_shingles"))
            .join(saved(final, "components"), F.col("doc_id") == F.col("doc"), "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))
