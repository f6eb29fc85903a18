"""Periodic runs of words by internal pattern matching.

A run is a stretch of consecutive words with smallest period ``q`` and at least
``max(min_words, 2 * q)`` words that no neighbouring word extends keeping that
period. It holds a whole *dyadic block* (``B = 2**k`` words from a multiple of
``B``) in its first ``2 * B - 1`` words, and the same block again ``q`` words
on, for every ``B <= (max(min_words, 2 * q) - q + 1) / 2``. So each period has
one level ``B``, the largest such, and is found as follows:

1. *Suffix array.* Prefix doubling over the words of all documents of a piece,
   the document being part of the first key. At level ``B`` equal blocks are one
   interval of the array; only intervals of two suffixes and more are refined,
   so plain text is sorted after a few rounds.
2. *Wavelet tree* over the positions in suffix order. "The next occurrence of
   this block at or after ``x``" is a range successor: the rank of ``x`` in the
   block's interval, then that quantile. Every block asks only in the
   neighbouring window of distances that belong to its level.
3. *Progressions.* Occurrences at most ``B / 2`` apart are an arithmetic
   progression whose step is the block's own period ``p``; its end follows from
   one longest common extension, and its members (one occurrence otherwise)
   give the candidate periods. A progression in the block's own stretch of
   period ``p`` can only give multiples of ``p`` and is passed over.
4. Candidates are extended to both sides by hashed longest common extensions;
   of equal stretches the one with the smallest period is the run.

Words are compared by 64-bit hashes. Work is ``O(w log**2 w)`` per piece of
``w`` words, a piece being whole documents of about half a megabyte or one
longer document; memory is some ``8 * log2(w)`` bytes per repeated word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Text, byte_hash, mapped, prefix, run_hash, texts

MIN_WORDS = 12


class WaveletTree:
    """Counts and quantiles of values below ``size`` in ranges of a sequence;
    all arguments are arrays with one entry per query."""

    def __init__(self, values: np.ndarray, size: int):
        self.size, self.levels = size, []
        for bit in range(max(1, (size - 1).bit_length()) - 1, -1, -1):
            one = (values >> bit) & 1
            ones = np.zeros(len(values) + 1, np.int32)
            np.cumsum(one, out=ones[1:])
            self.levels.append((bit, ones, len(values) - int(ones[-1])))
            values = np.concatenate([values[one == 0], values[one == 1]])

    def less(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of ``[lo, hi)`` are below ``x < size``."""
        count = np.zeros(len(x), np.int64)
        for bit, ones, zeros in self.levels:
            a, b = ones[lo], ones[hi]
            up = (x >> bit & 1) == 1
            count += np.where(up, hi - b - (lo - a), 0)
            lo, hi = np.where(up, zeros + a, lo - a), np.where(up, zeros + b, hi - b)
        return count

    def kth(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The ``k``-th smallest value of ``[lo, hi)``, from 0."""
        value = np.zeros(len(k), np.int64)
        for bit, ones, zeros in self.levels:
            a, b = ones[lo], ones[hi]
            n = hi - b - (lo - a)
            up = k >= n
            k = np.where(up, k - n, k)
            value |= up.astype(np.int64) << bit
            lo, hi = np.where(up, zeros + a, lo - a), np.where(up, zeros + b, hi - b)
        return value

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The smallest value of ``[lo, hi)`` that is ``x`` or more, else -1."""
        found = np.full(len(x), -1, np.int64)
        some = np.flatnonzero(x < self.size)
        lo, hi = lo[some], hi[some]
        k = self.less(lo, hi, x[some])
        there = k < hi - lo
        found[some[there]] = self.kth(lo[there], hi[there], k[there])
        return found


def levels(min_words: int, longest: int) -> dict[int, list[tuple[int, int]]]:
    """Block length -> ranges ``(least, most)`` of the periods found through it,
    for documents of ``longest`` words."""
    out: dict[int, list[tuple[int, int]]] = {}
    q = 1
    while 2 * q <= longest:
        size = 1 << (((max(min_words, 2 * q) - q + 1) // 2).bit_length() - 1)
        # Beyond min_words the level of q holds up to 4 * size - 2.
        to = 4 * size - 2 if 2 * q >= min_words else q
        spans = out.setdefault(size, [])
        if spans and spans[-1][1] == q - 1:
            spans[-1] = spans[-1][0], to
        else:
            spans.append((q, to))
        q = to + 1
    return out


def _blocks(word: np.ndarray, doc: np.ndarray, end: np.ndarray, min_words: int, longest: int):
    """The suffix array's positions that can matter, and the questions ``(block,
    size, lo, hi, least, most)``: does the block at ``block`` occur ``least`` to
    ``most`` words on; its occurrences are ``positions[lo:hi]``."""
    n = len(word)
    by = np.lexsort((word, doc))
    new = np.ones(n, bool)
    new[1:] = (word[by[1:]] != word[by[:-1]]) | (doc[by[1:]] != doc[by[:-1]])
    rank = np.empty(n, np.int64)
    rank[by] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    many = np.bincount(rank, minlength=n)
    wanted, asked, size = levels(min_words, longest), [], 1
    while True:
        for least, most in wanted.get(size, ()):
            b = np.arange(0, n, size)
            b = b[(many[rank[b]] > 1) & (b + least + size <= end[b])]
            asked.append((b, np.full(len(b), size), rank[b], rank[b] + many[rank[b]],
                          np.full(len(b), least), np.full(len(b), most)))
        open_ = np.flatnonzero(many[rank] > 1)
        if not len(open_):
            break
        after = np.full(len(open_), -1, np.int64)
        inside = open_ + size < end[open_]
        after[inside] = rank[open_[inside] + size]
        by = np.lexsort((after, rank[open_]))
        open_, after = open_[by], after[by]
        old = rank[open_]
        head = np.ones(len(open_), bool)
        head[1:] = old[1:] != old[:-1]
        new = head.copy()
        new[1:] |= after[1:] != after[:-1]
        at = np.arange(len(open_))
        first = lambda mark: np.maximum.accumulate(np.where(mark, at, 0))
        rank[open_] = old + first(new) - first(head)
        many = np.bincount(rank, minlength=n)
        size *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    if not asked:
        return order, [np.empty(0, np.int64)] * 6
    return order, [np.concatenate(x) for x in zip(*asked)]


def find_runs(word: np.ndarray, doc: np.ndarray, min_words: int = MIN_WORDS
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words, ends and periods of all runs in the words ``word`` (64-bit
    hashes) of the documents ``doc`` (ascending), by start, then period."""
    none = np.empty(0, np.int64)
    if len(word) < 2:
        return none, none, none
    new = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    length = np.diff(np.append(new, len(word)))
    begin, end = np.repeat(new, length), np.repeat(new + length, length)
    order, (block, size, lo, hi, least, most) = _blocks(word, doc, end, min_words, int(length.max()))
    if not len(block):
        return none, none, none
    # Only positions in an interval that is asked for go into the tree.
    step = np.zeros(len(word) + 1, np.int64)
    np.add.at(step, lo, 1)
    np.add.at(step, hi, -1)
    use = np.cumsum(step[:-1]) > 0
    place = np.append(0, np.cumsum(use))
    kept = np.sort(order[use])
    tree = WaveletTree(np.searchsorted(kept, order[use]), len(kept))
    lo, hi = place[lo], place[hi]
    sums = prefix(word)

    def same(a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words, ``most`` at most, agree from (or before) ``a < b`` on."""
        t = np.zeros(len(a), np.int64)
        for bit in range(int(most.max(initial=0)).bit_length() - 1, -1, -1):
            u = t + (1 << bit)
            i = np.flatnonzero(u <= most)
            x, y, v = a[i], b[i], u[i]
            if back:
                ok = run_hash(sums, x - v, x) == run_hash(sums, y - v, y)
            else:
                ok = run_hash(sums, x, x + v) == run_hash(sums, y, y + v)
            t[i[ok]] = u[i[ok]]
        return t

    def after(x: np.ndarray) -> np.ndarray:
        """The next occurrence at or after ``x`` within the window, else -1."""
        o = tree.successor(lo, hi, np.searchsorted(kept, x))
        o = np.where(o >= 0, kept[o], -1)
        return np.where((o <= to) & (o + size <= end[block]), o, -1)

    starts, found = [], []
    x, to = block + least, block + most
    while len(block):
        one = after(x)
        go = one >= 0
        block, size, lo, hi, to, one = (v[go] for v in (block, size, lo, hi, to, one))
        if not len(block):
            break
        two = after(one + 1)
        p = two - one
        row = (two >= 0) & (2 * p <= size)
        last, x = one.copy(), np.where(two >= 0, two, to + 1)
        i = np.flatnonzero(row)
        a, b, p, w = one[i], block[i], p[i], size[i]
        reach = a + p + same(a, a + p, end[b] - a - p)
        last[i] = np.minimum(a + (reach - w - a) // p * p, to[i])
        last[i] -= (last[i] - a) % p
        x[i] = last[i] + 1
        # In the block's own stretch of period p only p itself can be a period.
        own = same(b, b + p, a + w - p - b) >= a + w - p - b
        last[i[own]] = a[own]
        single = np.ones(len(block), bool)
        single[i] = ~own | (a - b == p)
        j = np.flatnonzero(single)
        gap = np.ones(len(block), np.int64)
        gap[i] = p
        many = (last[j] - one[j]) // gap[j] + 1
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        starts.append(np.repeat(block[j], many))
        found.append(np.repeat(one[j], many) + at * np.repeat(gap[j], many))
    a, b = np.concatenate([none, *starts]), np.concatenate([none, *found])
    q = b - a
    right = b + same(a, b, end[a] - b)
    left = a - same(a, b, a - begin[a], back=True)
    ok = right - left >= np.maximum(min_words, 2 * q)
    left, right, q = left[ok], right[ok], q[ok]
    by = np.lexsort((q, right, left))
    left, right, q = left[by], right[by], q[by]
    first = np.ones(len(q), bool)
    first[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    left, right, q = left[first], right[first], q[first]
    by = np.lexsort((q, left))
    return left[by], right[by], q[by]


def _joined(t: Text, start: np.ndarray, end: np.ndarray, doc: np.ndarray) -> pa.Array:
    """The words ``start .. end`` of each document, joined by one space."""
    size = end - start + 1
    to = np.cumsum(size)
    raw = t.data[np.minimum(np.repeat(start - (to - size), size) + np.arange(to[-1] if len(to) else 0),
                            max(0, len(t.data) - 1))]
    raw[to - 1] = 0x20
    last = np.append(doc[1:] != doc[:-1], True)[:len(doc)]
    keep = np.ones(len(raw), bool)
    keep[to[last] - 1] = False
    off = np.zeros(len(t) + 1, np.int64)
    np.add.at(off[1:], doc, size)
    off[1:][doc[last]] -= 1
    return pa.Array.from_buffers(pa.large_string(), len(t), [
        None, pa.py_buffer(np.cumsum(off)), pa.py_buffer(raw[keep].tobytes())])


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, text_col: str = "text", *, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without ``text_col`` and with ``n_words``, ``runs`` (array of
    ``start, length, period``, by start, then period; starts count words from 0)
    and ``collapsed``, the words that remain when every run keeps its first
    period only, joined by one space.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text and compared as they
    stand. A null, empty or blank text has no words, no runs and an empty
    ``collapsed``. Runs never cross documents; rows are independent, so repeated
    rows and ids have equal results and nothing is shuffled. Columns named like
    an added one are replaced; an empty table stays empty.
    """
    if min_words < 2:
        raise ValueError("a run has two words at least")
    added = ["n_words", "runs", "collapsed"]
    keep = [c for c in docs.columns if c != text_col and c not in added]

    def run(batches):
        for batch in batches:
            n, at, parts, joined = [np.empty(0, np.int64)], [np.zeros(1, np.int64)], [], []
            total = 0
            for t in texts(batch.column(0)):
                start, end, doc = t.words()
                bounds = t.bounds(doc)
                left, right, q = find_runs(byte_hash(t.data, start, end), doc, min_words)
                step = np.zeros(len(doc) + 1, np.int64)
                np.add.at(step, left + q, 1)
                np.add.at(step, right, -1)
                stay = np.cumsum(step[:-1]) == 0
                joined.append(_joined(t, start[stay], end[stay], doc[stay]))
                n.append(np.diff(bounds))
                owner = doc[left]
                parts.append((left - bounds[owner], right - left, q))
                at.append(total + np.searchsorted(owner, np.arange(1, len(t) + 1)))
                total += len(q)
            cols = [np.concatenate(x) for x in zip(*parts)] or [np.empty(0, np.int64)] * 3
            runs = pa.ListArray.from_arrays(
                pa.array(np.concatenate(at), pa.int32()),
                pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in cols], fields=list(_RUN)))
            texts_ = pa.concat_arrays(joined) if joined else pa.array([], pa.large_string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(np.concatenate(n), pa.int64()), runs, texts_.cast(pa.string())],
                [*batch.schema.names[1:], *added])
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    return mapped(docs.select(F.col(text_col).cast("string").alias("_text"), *keep), run, ", ".join(
        [*kinds, "n_words long", "runs array<struct<start:long,length:long,period:long>>", "collapsed string"]))
