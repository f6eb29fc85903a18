"""Near-duplicate vectors through inverted lists and product quantisation.

1. *Fit.* Coarse centroids and, over the residuals, one small codebook per
   subspace, by k-means on a bounded sample (``SAMPLE_ROWS`` at most).
2. *Lists.* Every vector lives in the list of its nearest centroid, within its
   label, as a residual code of one byte per subspace. It visits each other list
   whose bisector with its own is near: of two linked vectors with different
   homes, one lies within half their distance across the bisector, and of a
   distance ``t`` in ``D`` dimensions a direction has about ``t / sqrt(D)``.
   ``SIGMAS`` of these per vector, twice as many per pair, are the probes.
3. *Distances.* A vector that searches a list builds one table per subspace and
   adds up one entry per code (asymmetric distance). The code's own error is
   kept, so by the triangle inequality ``distance > t + error`` excludes a link:
   within the lists probed nothing is lost.
4. *Rerank.* Survivors are compared by their exact cosine in double precision.

Links do not leave a task as pairs: a task returns, per vector, how many links
it found and one edge of a spanning forest, so a dense group of near copies
costs comparisons but few rows. Lists of more than ``BLOCK_ROWS`` members are
dealt out in blocks; visitors stream past a block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, saved
from .components import components

COSINE = 0.93
LIST_ROWS = 1_024        # vectors per list that the number of lists aims at, over all labels
MAX_LISTS = 16_384
SAMPLE_ROWS = 65_536     # vectors that the index is fitted on, at most
SUBSPACE = 4             # dimensions of a subspace
CODES = 64               # codes of a subspace
SIGMAS = 1.75
BLOCK_ROWS = 4_096       # members of a list that one task holds, twice at most
CELLS = 1 << 21          # distances at once
ROUNDS = 8               # of k-means


@dataclass
class Index:
    """Coarse centroids, and per subspace its codes."""

    centroids: np.ndarray   # lists x dimensions
    codes: np.ndarray       # subspaces x CODES x SUBSPACE

    @property
    def dims(self) -> int:
        return self.centroids.shape[1]

    def home(self, x: np.ndarray) -> np.ndarray:
        return _nearest(x, self.centroids)

    def encode(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and the distance of each residual from what they stand for."""
        parts = residual.reshape(len(residual), -1, SUBSPACE)
        code = np.stack([_nearest(parts[:, m], c) for m, c in enumerate(self.codes)], 1).astype(np.uint8)
        back = self.codes[np.arange(len(self.codes)), code]
        return code, np.sqrt(((parts - back) ** 2).sum((1, 2)))

    def visits(self, x: np.ndarray, home: np.ndarray, reach: float) -> list[np.ndarray]:
        """Per vector the other lists whose bisector with its home is within ``reach``."""
        c = self.centroids
        out = []
        step = max(1, CELLS // len(c))
        for i in range(0, len(x), step):
            v, h = x[i:i + step], home[i:i + step]
            far = (c ** 2).sum(1) - 2 * v @ c.T
            far -= far[np.arange(len(v)), h][:, None]
            own = c[h]
            apart = np.sqrt(np.maximum((own ** 2).sum(1)[:, None] + (c ** 2).sum(1) - 2 * own @ c.T, 0))
            near = far <= 2 * reach * apart
            near[np.arange(len(v)), h] = False
            out.extend(np.flatnonzero(row) for row in near)
        return out

    def tables(self, residual: np.ndarray) -> np.ndarray:
        """Squared distances of every part of a residual from every code."""
        parts = residual.reshape(len(residual), -1, 1, SUBSPACE)
        return ((parts - self.codes) ** 2).sum(3).astype(np.float32)


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    norm, step = (c ** 2).sum(1), max(1, CELLS // len(c))
    return np.concatenate([np.empty(0, np.int64), *(
        np.argmin(norm - 2 * x[i:i + step] @ c.T, 1) for i in range(0, len(x), step))])


def _kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` centres; an empty one stays where it was."""
    rng = np.random.default_rng(seed)
    c = x[rng.permutation(len(x))[np.arange(k) % len(x)]].copy()
    for _ in range(ROUNDS):
        near = _nearest(x, c)
        many = np.bincount(near, minlength=k)
        total = np.stack([np.bincount(near, x[:, d], k) for d in range(x.shape[1])], 1)
        c[many > 0] = total[many > 0] / many[many > 0, None]
    return c


def fit(sample: np.ndarray, lists: int, seed: int = 1) -> Index:
    """An index from unit vectors (their dimensions a multiple of ``SUBSPACE``)."""
    centroids = _kmeans(sample, lists, seed)
    parts = (sample - centroids[_nearest(sample, centroids)]).reshape(len(sample), -1, SUBSPACE)
    return Index(centroids, np.stack([_kmeans(np.ascontiguousarray(parts[:, m]), CODES, seed + m)
                                      for m in range(parts.shape[1])]))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Vectors as rows of ``dims`` doubles, the shorter ones ending in zeros."""
    many = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(many), dims))
    row = np.repeat(np.arange(len(many)), many)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(many) - many, many)] = flat
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that very small and very large components keep their digits.
    x = x / np.abs(x).max(1, initial=0, keepdims=True)
    return x / np.sqrt((x ** 2).sum(1, keepdims=True))


def _encoded(index: Index, reach: float):
    def run(batches):
        for batch in batches:
            x = _unit(_matrix(batch.column("v"), index.dims))
            home = index.home(x)
            code, error = index.encode(x - index.centroids[home])
            visits = index.visits(x, home, reach)
            at = np.cumsum([0, *map(len, visits)])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "h", "label", "copies", "v")), pa.array(home, pa.int32()),
                 pa.array([c.tobytes() for c in code], pa.binary()), pa.array(error, pa.float64()),
                 pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(
                     np.concatenate([np.empty(0, np.int64), *visits]), pa.int32()))],
                ["id", "h", "label", "copies", "v", "home", "code", "error", "visits"])
    return run


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest number that each of ``n`` nodes reaches over links ``a - b``."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


class _Group:
    """Members of (two blocks of) a list, and the links found so far."""

    def __init__(self, index: Index, least: float, rows: pa.Table, apart: bool):
        self.index, self.least = index, least
        self.list = rows["list"][0].as_py()
        self.bound = np.sqrt(2 - 2 * least)
        self.of(self, rows)
        self.code = np.frombuffer(b"".join(rows["code"].to_pylist()), np.uint8).reshape(len(self.x), -1).astype(np.int64)
        self.error = rows["error"].to_numpy()
        visits = rows["visits"].combine_chunks()
        many = np.diff(visits.offsets.to_numpy())
        lists = visits.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.seen = np.sort(np.repeat(np.arange(len(many)), many) * len(index.centroids) + lists)
        self.n = np.zeros(len(self.x), np.int64)
        block = rows["block"].to_numpy()
        a, b = [], []
        for q, c in self.links(self.x):
            ok = (block[q] < block[c]) if apart else (q < c)
            q, c = q[ok], c[ok]
            np.add.at(self.n, q, self.copies[c])
            np.add.at(self.n, c, self.copies[q])
            a, b = self.shorter([*a, q], [*b, c], len(self.x))
        self.label = _forest(np.concatenate([np.empty(0, np.int64), *a]), np.concatenate([np.empty(0, np.int64), *b]), len(self.x))

    @staticmethod
    def of(to, rows) -> None:
        to.id, to.h, to.copies = (rows[c].to_numpy() for c in ("id", "h", "copies"))
        v = rows["v"]
        to.x = _unit(_matrix(v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v, to.index.dims))

    @staticmethod
    def shorter(a: list, b: list, n: int) -> tuple[list, list]:
        """Links reduced to a forest when they are many."""
        if sum(map(len, a)) <= 8 * n + 1000:
            return a, b
        label = _forest(np.concatenate(a), np.concatenate(b), n)
        far = np.flatnonzero(label != np.arange(n))
        return [far], [label[far]]

    def links(self, x: np.ndarray):
        """Numbers ``(row of x, member)`` of vectors linked by their exact cosine,
        from table look-ups and rerank, in parts of bounded size."""
        sub = np.arange(self.code.shape[1])
        step = max(1, CELLS // max(len(self.x), sub.size * CODES * SUBSPACE))
        for i in range(0, len(x), step):
            q = x[i:i + step]
            table = self.index.tables(q - self.index.centroids[self.list])
            far = np.zeros((len(q), len(self.x)), np.float32)
            for m in sub:
                far += table[:, m].take(self.code[:, m], axis=1)
            # The slack covers the rounding of single precision.
            r, c = np.nonzero(far <= ((self.bound + self.error) ** 2 * 1.0001 + 1e-4).astype(np.float32))
            if 8 * len(r) > far.size:
                ok = (q @ self.x.T)[r, c] >= self.least
            else:
                ok = np.concatenate([np.empty(0, bool), *(
                    np.einsum("ij,ij->i", q[r[j:j + 65536]], self.x[c[j:j + 65536]]) >= self.least
                    for j in range(0, len(r), 65536))])
            yield r[ok] + i, c[ok]

    def own(self):
        """Rows ``(id, h, n, link)`` of the members that have links."""
        return self.rows(self.id, self.h, self.n, self.label)

    @staticmethod
    def rows(id_: np.ndarray, h: np.ndarray, n: np.ndarray, label: np.ndarray):
        some = np.flatnonzero(n)
        return id_[some], h[some], n[some], id_[label[some]]

    def visit(self, batch: pa.RecordBatch):
        """Rows of the visitors of a batch and of the members they link to."""
        guest = type("Guests", (), {"index": self.index})()
        self.of(guest, batch)
        home, lists = batch["home"].to_numpy().astype(np.int64), len(self.index.centroids)
        n, m = len(guest.x), len(self.x)
        count, a, b = np.zeros(m + n, np.int64), [], []
        for g, c in self.links(guest.x):
            # A pair whose members visit each other counts in the lower list.
            key = c * lists + home[g]
            at = np.searchsorted(self.seen, key)
            both = self.seen[np.minimum(at, len(self.seen) - 1)] == key if len(self.seen) else np.zeros(len(g), bool)
            ok = ~both | (home[g] > self.list)
            g, c = g[ok], c[ok]
            np.add.at(count, m + g, self.copies[c])
            np.add.at(count, c, guest.copies[g])
            a, b = self.shorter([*a, m + g], [*b, c], m + n)
        none = np.empty(0, np.int64)
        label = _forest(np.concatenate([none, *a]), np.concatenate([none, *b]), m + n)
        return self.rows(np.append(self.id, guest.id), np.append(self.h, guest.h), count, label)


def _searched(index: Index, least: float):
    """``(id, h, n, link)`` from the rows of the lists, sorted by list and blocks,
    members first."""
    def out(parts):
        cols = [np.concatenate(x) for x in zip(*parts)] or [np.empty(0, np.int64)] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["id", "h", "n", "link"])

    def run(batches):
        key, held, group = None, [], None
        names = ("label", "list", "lo", "hi")

        def close():
            """The members of a group are complete."""
            table = pa.Table.from_batches(held)
            return _Group(index, least, table, table["lo"][0].as_py() != table["hi"][0].as_py())

        for batch in batches:
            ids = np.stack([batch[c].to_numpy() for c in (*names, "guest")], 1).astype(np.int64)
            cut = np.flatnonzero((ids[1:] != ids[:-1]).any(1)) + 1
            for i, j in zip(np.append(0, cut), np.append(cut, len(ids))):
                if i == j:
                    continue
                some, now = batch.slice(i, j - i), tuple(ids[i, :4])
                if now != key:
                    if held and group is None:
                        yield out([close().own()])
                    key, held, group = now, [], None
                if not ids[i, 4]:
                    held.append(some)
                elif held:
                    if group is None:
                        group = close()
                        yield out([group.own()])
                    yield out([group.visit(some)])
        if held and group is None:
            yield out([close().own()])
    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", *, least: float = COSINE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row: the number of other
    rows of the same label whose cosine is ``least`` or more, the smallest id
    reachable over such links, and whether that is the row's own.

    Rows whose label or vector is null, whose vector is empty, zero or holds a
    null or non-finite component have no links. Vectors of different lengths
    compare as if the shorter ended in zeros. Equal vectors are searched once and
    counted with their number. Rows that share an id count one by one and share
    a component. A row without an id takes no part (component null, not kept).
    Other columns are ignored; no rows, no result.

    Every link that is returned is exact. A link can be missed only if a pair
    lies further across a bisector than ``2 * SIGMAS`` times the distance of a
    random direction; recall is measured against brute force in the tests. The
    number of links of each of ``m`` near copies takes their ``m**2 / 2``
    comparisons, in blocks; rows shuffled grow with ``m / BLOCK_ROWS`` there.
    """
    if not 0 < least <= 1:
        raise ValueError("the cosine must lie in (0, 1]")
    v, ident = F.col(vector_col), F.col(id_col).cast("long")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) | ~F.exists(v, lambda x: x != 0)
    fine = ident.isNotNull() & F.col(label_col).isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(True))
    label = F.col(label_col).cast("string")
    # Single-precision vectors travel as such; all sums are in double precision.
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(ident.alias("id"), F.when(fine, F.xxhash64(label, v)).alias("h"),
                          F.when(fine, F.xxhash64(v, F.lit(1), label)).alias("h2"), label.alias("_label"),
                          F.when(fine, v if kind == "array<float>" else v.cast("array<double>")).alias("v"))
    some = rows.where("h is not null")
    groups = saved(some.groupBy("h", "h2").agg(F.min(F.struct("id", F.xxhash64("_label").alias("label"), "v")).alias("r"),
                                               F.count("*").alias("copies"))
                   .select("h", "h2", "r.*", "copies"), "vectors")
    narrow = rows.select("id", "h", "h2")
    n, dims = groups.agg(F.count("*"), F.max(F.size("v"))).first()
    if not n:
        return narrow.select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
                             F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    dims = -(-dims // SUBSPACE) * SUBSPACE
    lists = int(min(MAX_LISTS, max(1, n // LIST_ROWS)))
    sample = groups.select("v", F.xxhash64("h", "h2").alias("s")).orderBy("s").limit(min(SAMPLE_ROWS, max(4_096, 16 * lists)))
    index = fit(_unit(_matrix(sample.select("v").toArrow()["v"].combine_chunks(), dims)), lists)

    reach = SIGMAS * float(np.sqrt(2 - 2 * least) / np.sqrt(dims))
    coded = saved(mapped(groups.select("id", "h", "label", "copies", "v"), _encoded(index, reach),
                         f"id long, h long, label long, copies long, v {kind}, home int, code binary, "
                         "error double, visits array<int>"), "coded")
    size = saved(coded.groupBy("label", F.col("home").alias("list")).agg(
        F.ceil(F.count("*") / BLOCK_ROWS).cast("long").alias("s")), "lists")
    base = ["id", "h", "label", "copies", "v", "home"]
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("s") - 1))
    members = (coded.withColumn("list", F.col("home")).join(size, ["label", "list"])
               .withColumn("block", F.pmod(F.xxhash64("id", "h"), F.col("s"))).withColumn("o", each)
               .select(*base, "list", F.least("block", "o").alias("lo"), F.greatest("block", "o").alias("hi"),
                       "block", F.lit(0).alias("guest"), "code", "error", "visits"))
    guests = (coded.select(*base, F.explode("visits").alias("list")).join(size, ["label", "list"])
              .withColumn("o", each)
              .select(*base, "list", F.col("o").alias("lo"), F.col("o").alias("hi"), F.col("o").alias("block"),
                      F.lit(1).alias("guest"), F.lit(None).cast("binary").alias("code"),
                      F.lit(None).cast("double").alias("error"), F.lit(None).cast("array<int>").alias("visits")))
    by = ["label", "list", "lo", "hi"]
    found = saved(mapped(members.union(guests).repartition(*by).sortWithinPartitions(*by, "guest"),
                         _searched(index, least), "id long, h long, n long, link long"), "links")
    counts = found.groupBy("id", "h").agg(F.sum("n").alias("n"))
    # Copies of one vector hang on the smallest id.
    copies = groups.where("copies > 1").select("h", "h2", F.col("id").alias("rep"))
    edges = found.select(F.col("id").alias("a"), F.col("link").alias("b")).where("a <> b")
    edges = edges.union(some.select("id", "h", "h2").join(copies, ["h", "h2"]).select("rep", "id").where("rep <> id"))
    label_of = components(edges.distinct())
    total = groups.select("h", "h2", "id", "copies").join(counts, ["id", "h"], "left").select(
        "h", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return (narrow.where("h is not null").join(saved(total, "counts"), ["h", "h2"]).select("id", "n_links")
            .union(narrow.where("h is null").select("id", F.lit(0).cast("long")))
            .join(label_of, F.col("id") == F.col("node"), "left")
            .select(F.col("id").alias("vec_id"), "n_links", F.coalesce("label", "id").alias("component_id"),
                    F.coalesce(F.coalesce("label", "id") == F.col("id"), F.lit(False)).alias("kept")))
