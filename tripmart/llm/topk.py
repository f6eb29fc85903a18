"""Exact top-k search by the threshold algorithm.

Vectors are turned into integers ``floor(scale * x)``. Every block of candidates
keeps one list per dimension, sorted by the component. The queries of a group
read the lists from the ends that suit the signs of their components, a step of
places from all lists at once, and the vectors met for the first time are scored
by random access, for all queries that still search, in one product. The bound, the sum of the query's components times the last
values read, is the most that a vector not met so far can score; the search of
the block ends when the bound is below the k-th best score.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 64
K = 20
BLOCK_ROWS = 8192     # candidates of a block
QUERY_ROWS = 4096     # queries that search a block in one task
CELLS = 1 << 21       # scores at once
STEP = 48             # places read from every list at once, growing by half
_NONE = np.iinfo(np.int64).min   # no score


class Lists:
    """Sorted lists of a block of integer vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").T.copy()        # dimension x place
        self.sorted = np.take_along_axis(vectors.T, self.order, 1)
        self.scored = 0   # vectors scored, times the queries that they were scored for

    def search(self, q: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of ``q``, ids and scores of the ``k`` best of each (ties to smaller
        ids), without the query's ``own`` id. The lists are read once for all
        queries that still search; what one of them meets is scored for all."""
        n, m = len(self.ids), len(q)
        # Doubles hold whole numbers up to 2**53; beyond, slower 64-bit integers.
        small = float(np.abs(q).sum(1).max(initial=0)) * float(np.abs(self.vectors).max(initial=0)) < 2 ** 53
        kind = np.float64 if small else np.int64
        best = [(np.empty(0, np.int64), np.empty(0, np.int64))] * m
        least = np.full(m, _NONE)   # the k-th best score so far
        met, active, depth, step = np.zeros(n, bool), np.arange(m), 0, STEP
        vectors, q = self.vectors.astype(kind), q.astype(kind)
        while depth < n and len(active):
            to = min(n, depth + step)
            up, down = (q[active] > 0).any(0), (q[active] < 0).any(0)
            now = np.zeros(n, bool)
            now[self.order[up, n - to:n - depth]] = True
            now[self.order[down, depth:to]] = True
            if to == n:
                now[:] = True
            new = np.flatnonzero(now & ~met)
            met |= now
            self.scored += len(new) * len(active)
            part = max(1, CELLS // max(1, len(new)))
            for i in range(0, len(active) if len(new) else 0, part):
                some = active[i:i + part]
                score = (q[some] @ vectors[new].T).astype(np.int64)
                score[self.ids[new] == own[some][:, None]] = _NONE
                floor = np.maximum(least[some], _NONE + 1)
                if len(new) > k:
                    floor = np.maximum(floor, np.partition(score, len(new) - k, axis=1)[:, len(new) - k])
                for j, x in enumerate(some):
                    good = np.flatnonzero(score[j] >= floor[j])
                    ids = np.append(best[x][0], self.ids[new[good]])
                    value = np.append(best[x][1], score[j, good])
                    first = np.lexsort((ids, -value))[:k]
                    best[x] = ids[first], value[first]
                    if len(first) == k:
                        least[x] = value[first[-1]]
            # The most that a vector not met so far can score.
            high, low = self.sorted[:, n - to].astype(kind), self.sorted[:, to - 1].astype(kind)
            bound = np.maximum(q[active], 0) @ high + np.minimum(q[active], 0) @ low
            active = active[(bound >= least[active]) | (np.array([len(best[x][0]) for x in active]) < k)]
            depth, step = to, step + step // 2
        many = [len(b[0]) for b in best]
        return (np.repeat(np.arange(m), many), np.concatenate([np.empty(0, np.int64), *(b[0] for b in best)]),
                np.concatenate([np.empty(0, np.int64), *(b[1] for b in best)]))


def _search(k: int):
    def run(key, cand: pd.DataFrame, quer: pd.DataFrame) -> pd.DataFrame:
        out: list[list] = [[], [], []]
        if len(cand) and len(quer):
            dims = max(cand["v"].map(len).max(), quer["v"].map(len).max())
            rows = lambda col: np.array([np.pad(v, (0, dims - len(v))) for v in col], np.int64)
            lists, own = Lists(cand["id"].to_numpy(), rows(cand["v"])), quer["id"].to_numpy()
            row, ids, score = lists.search(rows(quer["v"]), own, k)
            out = [[own[row]], [ids], [score]]
        return pd.DataFrame({n: np.concatenate(x) if x else np.empty(0, np.int64)
                             for n, x in zip(("query_id", "vec_id", "score"), out)})
    return run


def topk(vectors: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", *,
         k: int = K, scale: int = SCALE) -> DataFrame:
    """For every row with ``is_query`` (a Column over ``vectors``) the ``k``
    highest integer inner products with the other rows: ``(query_id, rank,
    vec_id, score)``, ranks from 1, ties to the smaller id, fewer rows if there
    are fewer candidates.

    Rows whose id or vector is null, or whose vector holds a null, NaN or
    infinite component, take no part. Vectors of different lengths compare as if
    the shorter ended in zeros. Rows that share an id count each as a candidate;
    a query leaves out all rows of its own id and is asked once per id and vector.
    Components must keep scores within 64 bits.

    Candidates are dealt into blocks and queries into groups, both of bounded
    size, and every group searches every block in a task of its own; the k best
    per block are merged. The work is queries x rows / block size.
    """
    v, ident = F.col(vector_col), F.col(id_col).cast("long")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = (vectors.where(ident.isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(True)))
            .select(ident.alias("id"), whole.alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")))
    n, n_q = rows.agg(F.count("*"), F.count_if("q")).first()
    blocks, groups = max(1, -(-n // BLOCK_ROWS)), max(1, -(-n_q // QUERY_ROWS))
    deal = lambda m, *by: F.pmod(F.xxhash64(*by), F.lit(m)).cast("int")
    each = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    cand = rows.select("id", "v", deal(blocks, "id", "v").alias("block"), each(groups).alias("part"))
    quer = rows.where("q").select("id", "v").distinct().select(
        "id", "v", deal(groups, "id", "v").alias("part"), each(blocks).alias("block"))
    found = (cand.groupBy("block", "part").cogroup(quer.groupBy("block", "part"))
             .applyInPandas(_search(k), "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
