"""Packing of tokenized documents by Karmarkar-Karp multiway differencing.

A document is cut into whole windows of ``capacity`` ids, which are sequences
of their own, and a rest, which is cut into pieces of ``piece`` ids at most. The
rests of a group of documents are dealt into ``m`` windows: every piece begins
as a partial partition of ``m`` sums; the two partitions with the largest
imbalance are merged, the fullest windows of one with the emptiest of the other,
until one is left. Its windows are nearly equal. ``m`` starts at the least
possible count and rises while the fullest window exceeds the capacity.
"""

from __future__ import annotations

import base64
import heapq
import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Text, byte_hash, mapped, texts

CAPACITY = 1024
PIECE = 256
WINDOWS = 64           # windows' worth of rests in a group
MEMO = 250_000         # words whose ids a task remembers


def karmarkar_karp(sizes: list[int], m: int) -> list[list[int]]:
    """Deal items into ``m`` near-equal windows; returns the items of each."""
    if m == 1 or not sizes:
        return [list(range(len(sizes)))] + [[] for _ in range(m - 1)]
    # A partition is (imbalance, number, [(sum, items)]), sums relative to the
    # least one; only windows above it are listed, so a merge is cheap.
    heap = [(-s, i, [(s, [i])]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    count = len(heap)
    while len(heap) > 1:
        _, _, x = heapq.heappop(heap)
        _, _, y = heapq.heappop(heap)
        # x: fullest first; y: fullest last. Windows not listed are empty sums.
        both = []
        pad_x, pad_y = m - len(x), m - len(y)
        left = x + [(0, [])] * pad_x if len(x) + len(y) > m else None
        if left is None:
            both = x + y
        else:
            right = [(0, [])] * pad_y + y[::-1]
            both = [(a + b, p + q) for (a, p), (b, q) in zip(left, right)]
        both.sort(key=lambda w: -w[0])
        low = both[-1][0] if len(both) == m else 0
        both = [(a - low, p) for a, p in both]
        heapq.heappush(heap, (-both[0][0], count, both))
        count += 1
    done = [p for _, p in heap[0][2]]
    return done + [[] for _ in range(m - len(done))]


def deal(sizes: list[int], capacity: int) -> list[list[int]]:
    """Items by window, no window above ``capacity``."""
    m = max(1, -(-sum(sizes) // capacity))
    while True:
        windows = karmarkar_karp(sizes, m)
        if max((sum(sizes[i] for i in w) for w in windows), default=0) <= capacity:
            return [w for w in windows if w]
        m += 1


# Bytes before which or at which a text may not be cut: white space and controls.
_BLANK = np.zeros(256, bool)
_BLANK[:0x21] = True


def _pieces(t: Text) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans that the tokenizer treats apart: a space after a visible
    character always begins a new one."""
    d = t.data
    cut = np.zeros(len(d) + 1, bool)
    if len(d) > 1:
        seen = ~_BLANK[d[:-1]]
        if (d >= 0xE1).any() or (d == 0xC2).any():  # white space beyond ASCII ends in such bytes
            two = np.append(d[0], d[:-2]) if len(d) > 2 else d[:1]
            three = np.append(d[:1].repeat(2), d[:-3])[:len(d) - 1]
            seen &= ~((two == 0xC2) & ((d[:-1] == 0x85) | (d[:-1] == 0xA0)))
            seen &= ~((three >= 0xE1) & (three <= 0xE3))
        cut[1:-1] = (d[1:] == 0x20) & seen
    cut[t.off] = True
    at = np.flatnonzero(cut)
    return at[:-1], at[1:]


def _grown(x: np.ndarray, n: int) -> np.ndarray:
    """``x`` with room for ``n`` entries."""
    if n <= len(x):
        return x
    more = np.zeros(2 * n, x.dtype)
    more[:len(x)] = x
    return more


class Words:
    """Token ids of whole texts, piece by piece.

    Each distinct piece (see ``_pieces``) is encoded once per task and its ids
    are kept under the hash of its bytes, up to ``MEMO`` pieces. With ``ranks``,
    the same vocabulary in tiktoken's form, new pieces of Latin script are
    encoded together by that library, which gives the same ids, and told apart
    by the byte lengths of the tokens.
    """

    def __init__(self, path: str, ranks: str | None, pattern: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # such strings in a text are text
        self.fast = None
        if ranks:
            import tiktoken
            with open(ranks, "rb") as f:
                table = {base64.b64decode(t): int(n) for t, n in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table,
                                          special_tokens={}).encode_ordinary
            self.width = np.zeros(max(table.values()) + 1, np.int64)
            self.width[list(table.values())] = [len(t) for t in table]
        self._clear()

    def _clear(self) -> None:
        self.known: dict[int, int] = {}
        self.flat = np.empty(1 << 16, "<u4")            # ids of all known pieces
        self.at = np.zeros(1 << 16, np.int64)           # where the ids of each piece end
        self.used = 0

    def _add(self, hashes: list[int], ids: np.ndarray, counts: np.ndarray) -> None:
        n = len(self.known) + 1
        self.flat = _grown(self.flat, self.used + len(ids))
        self.at = _grown(self.at, n + len(counts))
        self.flat[self.used:self.used + len(ids)] = ids
        self.at[n:n + len(counts)] = self.used + np.cumsum(counts)
        self.known.update(zip(hashes, range(n - 1, n - 1 + len(hashes))))
        self.used += len(ids)

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        joint = np.zeros(len(pieces), bool)
        if self.fast:
            joint[:] = [p[0] == 0x20 and len(p) > 1 and p[-1] > 0x20 and (p.isascii() or max(p) < 0xC9)
                        for p in pieces]
        some = [p for p, j in zip(pieces, joint) if j]
        if some:
            ids = np.array(self.fast(b"".join(some).decode()), "<u4")
            ends = np.cumsum([len(p) for p in some])
            last = np.searchsorted(np.cumsum(self.width[ids]), ends) + 1
            self._add(hashes[joint].tolist(), ids, np.diff(last, prepend=0))
        rest = [p.decode() for p, j in zip(pieces, joint) if not j]
        if rest:
            each = [e.ids for e in self.tok.encode_batch(rest, add_special_tokens=False)]
            self._add(hashes[~joint].tolist(), np.array([i for e in each for i in e], "<u4"),
                      np.array([len(e) for e in each]))

    def ids(self, t: Text) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of ``t`` in a row, and where each document begins."""
        start, end = _pieces(t)
        if not len(start):
            return np.empty(0, "<u4"), np.zeros(len(t) + 1, np.int64)
        if len(self.known) > MEMO:
            self._clear()
        h, first, which = np.unique(byte_hash(t.data, start, end), return_index=True, return_inverse=True)
        place = np.array([self.known.get(x, -1) for x in h.tolist()])
        new = np.flatnonzero(place < 0)
        if len(new):
            raw, a, b = t.data.tobytes(), start[first[new]].tolist(), end[first[new]].tolist()
            self._learn(h[new], [raw[i:j] for i, j in zip(a, b)])
            place[new] = [self.known[x] for x in h[new].tolist()]
        at = self.at[place][which]
        count = self.at[place + 1][which] - at
        before = np.append(0, np.cumsum(count))
        ids = self.flat[np.repeat(at - before[:-1], count) + np.arange(before[-1])]
        return ids, before[np.searchsorted(start, t.off)]


def _pack(vocabulary: tuple, capacity: int, piece: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        words = Words(*vocabulary)
        task = TaskContext.get()
        sequence = (task.partitionId() if task else 0) << 32
        full = capacity * 4
        rows, rests, room = [], [], 0

        def put(doc, start, ids, tokens, at):
            rows.append((doc, start, len(ids) // 4, ids, tokens, sequence, at))

        def flush():
            nonlocal sequence, rests, room
            for window in deal([len(r[2]) // 4 for r in rests], capacity):
                at = 0
                for i in sorted(window):
                    put(*rests[i], at)
                    at += len(rests[i][2]) // 4
                sequence += 1
            rests, room = [], 0

        def taken():
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows
                else [pa.array([], k) for k in kinds], names)
            rows.clear()
            return out

        for batch in batches:
            docs = batch.column(0).to_pylist()
            for t in texts(batch.column(1)):
                ids, at = words.ids(t)
                raw, at = ids.tobytes(), (at * 4).tolist()
                for d, (i, j) in enumerate(zip(at[:-1], at[1:])):
                    own, doc = raw[i:j] + end, docs[t.first + d]
                    tokens, cut = len(own) // 4, len(own) // full * full
                    for a in range(0, cut, full):
                        put(doc, a // 4, own[a:a + full], tokens, 0)
                        sequence += 1
                    for a in range(cut, len(own), piece * 4):
                        rests.append((doc, a // 4, own[a:a + piece * 4], tokens))
                    room += len(own) - cut
                    if room >= WINDOWS * full:
                        flush()
                yield taken()
        flush()
        yield taken()

    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", *,
         capacity: int = CAPACITY, piece: int = PIECE, end_id: int = 0,
         ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """Pieces of documents with their places in sequences of ``capacity`` ids:
    ``(doc_id, start, length, ids, doc_tokens, sequence_id, offset)``, ``ids``
    as little-endian unsigned 32-bit numbers.

    ``tokenizer`` is the path of a byte-level BPE file, present on every node;
    ``ranks`` and ``pattern`` may name the same vocabulary in tiktoken's form.
    A document is its ids and ``end_id``; a null or empty text is ``end_id``
    alone. Repeated rows and equal ids are packed once per row; a null id stays
    null; an empty table gives no pieces; other columns are ignored.

    Each task packs the documents that it reads, in groups of ``WINDOWS``
    windows, so there is no shuffle, memory is bounded by a group and one
    document, and a task that is run again gives the same pieces. Only the last
    group of a task can leave a window partly empty.
    """
    if not 0 < piece <= capacity:
        raise ValueError("a piece must fit into a sequence")
    return mapped(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")),
                  _pack((tokenizer, ranks, pattern), capacity, piece, end_id),
                  "doc_id long, start long, length long, ids binary, doc_tokens long, "
                  "sequence_id long, `offset` long")
