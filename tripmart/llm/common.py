"""Helpers of this subpackage: words of whole Arrow text columns, their hashes
in numpy, and tables written to the shared folder.

A word is ``[^\\x20\\x09-\\x0D]+`` over the UTF-8 bytes. Hashes are polynomial
prefix sums modulo 2**64, so any run of bytes or words costs two look-ups; a
final mixing step spreads the bits. Two different runs share a hash with a
chance of about 2**-60 per comparison.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path

U = np.uint64
# Bytes of text handled at once: bounds the temporary arrays of a task.
CHUNK_BYTES = 1 << 19
# Bytes of an Arrow batch, on the JVM's side and in Python.
BATCH_BYTES = 1 << 22
# Rows of lists whose keys are combined before the shuffle.
COMBINED_ROWS = 5000
# Largest bitmap of ids that is broadcast, in bits (16 MiB).
BITMAP_BITS = 1 << 27

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_P = 0x9E3779B97F4A7C15  # 5 modulo 8: its powers repeat as late as possible


class _Powers:
    """Powers of the base and of its inverse; never travels with a task."""

    def __init__(self):
        self.up = self.down = np.ones(1, U)

    def __reduce__(self):
        return _Powers, ()

    def grow(self, size: int) -> None:
        p = np.full((2, size), [[_P], [pow(_P, -1, 1 << 64)]], U)
        p[:, 0] = 1
        self.up, self.down = np.cumprod(p, axis=1)


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (one to one)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse."""
    if len(_POWERS.up) < n:
        _POWERS.grow(max(n, 2 * len(_POWERS.up)))
    return _POWERS.up[:n], _POWERS.down[:n]


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums for ``run_hash``, one longer than ``values``."""
    out = np.zeros(len(values) + 1, U)
    np.cumsum(values * powers(len(values))[0], out=out[1:])
    return out


def run_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each run ``[start, end)``, its length included."""
    h = (sums[end] - sums[start]) * powers(len(sums))[1][start]
    return mix(h + mix((end - start).astype(U)))


@dataclass
class Text:
    """Documents ``first .. first + len(off) - 1`` of a batch, as bytes."""

    first: int
    data: np.ndarray   # uint8
    off: np.ndarray    # document d is data[off[d]:off[d + 1]]

    def __len__(self) -> int:
        return len(self.off) - 1

    def spans(self, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and document of each longest run of bytes not ``apart``."""
        n, inside = len(self.data), ~apart
        new = np.zeros(n + 1, bool)
        new[self.off] = True
        start, end = inside.copy(), inside.copy()
        start[1:] &= apart[:-1] | new[1:-1]
        end[:-1] &= apart[1:] | new[1:-1]
        start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
        return start, end, np.searchsorted(self.off, start, "right") - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.spans(SPACE[self.data])

    def bounds(self, doc: np.ndarray) -> np.ndarray:
        """Where each document begins in an array sorted by document."""
        return np.searchsorted(doc, np.arange(len(self) + 1))


def byte_sums(data: np.ndarray) -> np.ndarray:
    return prefix(_BYTE[data])


def byte_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return run_hash(byte_sums(data), start, end)


def texts(column: pa.Array | pa.ChunkedArray, lower: bool = False) -> Iterator[Text]:
    """A text column (null: empty) in pieces of whole documents."""
    for part in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        arr = pc.fill_null(part.cast(pa.large_string()), "")
        if not len(arr):
            continue
        off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
        raw = arr.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw else np.empty(0, np.uint8)
        i = 0
        while i < len(arr):
            j = max(i + 1, int(np.searchsorted(off, off[i] + CHUNK_BYTES, "right")) - 1)
            piece = data[off[i]:off[j]]
            yield Text(i, LOWER[piece] if lower else piece, off[i:j + 1] - off[i])
            i = j


def shingle_hashes(t: Text, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every ``k``-word shingle; a document with fewer
    words has its whole sequence as one."""
    start, end, doc = t.words()
    sums = prefix(byte_hash(t.data, start, end))
    at = t.bounds(doc)
    n = np.diff(at)
    many = np.maximum(n - k + 1, (n > 0).astype(n.dtype))
    owner = np.repeat(np.arange(len(t)), many)
    first = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many) + at[owner]
    return run_hash(sums, first, np.minimum(first + k, at[owner + 1])), owner


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(U).view(np.int64))


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType = pa.int64()) -> pa.Array:
    """An Arrow list column from flat values and list bounds."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def mapped(df: DataFrame, run, schema: str) -> DataFrame:
    """``mapInArrow`` in bounded memory: tasks return the memory of their arrays
    when they end, so that workers that wait for the next task stay small, and
    batches hold ``BATCH_BYTES`` or one row (unless the session sets a bound of
    its own, other than Spark's 64 MiB)."""
    conf, bound = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(bound).lower() in ("67108864b", "67108864", "64m", "64mb"):
        conf.set(bound, str(BATCH_BYTES))

    def tidy(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)
    return df.mapInArrow(tidy, schema)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage and
    survives lost executors."""
    spark: SparkSession = df.sparkSession
    path = shared_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def maybe_in(rows: DataFrame, key: Column, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two parts: those whose key is certainly not in the one column
    of ``ids``, and all others. Keeps rows with long texts that need no join out
    of its shuffle.

    The ids are marked in a bitmap of 16 bits and more per id, ``BITMAP_BITS`` at
    most: a bounded table that is broadcast. Beyond that bound more rows fall
    into the second part, which the caller joins exactly anyway.
    """
    name = ids.columns[0]
    bits = min(BITMAP_BITS, 1 << max(15, (16 * ids.count()).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(c.cast("long")), F.lit(bits))
    marks = saved(ids.select(place(F.col(name)).alias("h")).groupBy(F.expr("h div 32768").alias("_bucket"))
                  .agg(F.bitmap_construct_agg(F.expr("h % 32768")).alias("_map")), "bitmap")
    some = rows.withColumn("_h", place(key)).withColumn("_bucket", F.expr("_h div 32768"))
    some = some.join(F.broadcast(marks), "_bucket", "left")
    byte = F.conv(F.hex(F.expr("substring(_map, cast(_h % 32768 div 8 as int) + 1, 1)")), 16, 10).cast("int")
    found = F.coalesce(F.expr("cast(_h % 8 as int)").isNotNull()
                       & (F.call_function("shiftright", byte, F.expr("cast(_h % 8 as int)")).bitwiseAND(1) == 1),
                       F.lit(False))
    some = some.withColumn("_maybe", found)
    own = [F.col(c) for c in rows.columns]
    return some.where("not _maybe").select(*own), some.where("_maybe").select(*own)


def _gathered(batches, rows: int):
    """Batches of ``rows`` rows, the last one of fewer."""
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            held.append(batch.slice(0, rows - n))
            n += held[-1].num_rows
            batch = batch.slice(held[-1].num_rows)
            if n == rows:
                yield pa.concat_batches(held)
                held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def _entries(batches):
    """Rows ``(key, doc, pivot, members)`` of the keys of ``COMBINED_ROWS`` rows,
    combined: the smallest document per key goes on with the number of its
    members, the others name it as pivot (members 0) and need not meet the key's
    other rows."""
    for batch in _gathered(batches, COMBINED_ROWS):
        order = np.argsort(batch.column(0).to_numpy(zero_copy_only=False), kind="stable")
        batch = batch.take(pa.array(order))
        col = batch.column(1)
        key = col.flatten().to_numpy(zero_copy_only=False)
        many = np.diff(col.offsets.to_numpy())
        doc = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), many)
        by = np.argsort(key, kind="stable")
        key, doc = key[by], doc[by]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(key)))
        pivot = np.repeat(doc[first], size)
        pivot[first] = 0  # not read; a constant packs better
        members = np.zeros(len(key), np.int32)
        members[first] = size
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key, doc, pivot, members)],
                                         ["key", "doc", "pivot", "members"])


def _shared(batches):
    """From entries sorted by (key, doc): ``(key, doc, pivot)`` of the keys with
    two members or more. Streams; only the last row of a batch is carried on."""
    held = None  # key, doc, pivot, shared
    for batch in batches:
        key, doc, pivot, members = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        rest = members == 0
        out = [(key[rest], doc[rest], pivot[rest])]
        key, doc, shared = key[~rest], doc[~rest], members[~rest] > 1
        if len(key):
            at = 0
            if held:
                key, doc = np.append(held[0], key), np.append(held[1], doc)
                shared = np.append(held[3], shared)
                at = held[2]
            same = key[1:] == key[:-1]
            new = np.append(True, ~same)
            run = np.cumsum(new) - 1
            pivot = doc[new]
            if held:
                pivot[0] = at
            pivot = pivot[run]
            shared[1:] |= same
            shared[:-1] |= same
            out.append((key[:-1][shared[:-1]], doc[:-1][shared[:-1]], pivot[:-1][shared[:-1]]))
            held = key[-1], doc[-1], pivot[-1], shared[-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x), pa.int64()) for x in zip(*out)], ["key", "doc", "pivot"])
    if held and held[3]:
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in held[:3]],
                                         ["key", "doc", "pivot"])


def shared_keys(lists_: DataFrame) -> DataFrame:
    """From ``(doc_id, keys)`` rows ``(key, doc, pivot)`` of the keys that occur
    twice or more, in one shuffle; ``pivot`` is the smallest document of the key,
    or of its batch. A key of very many documents is combined per batch first;
    the rows that this sets aside are dealt out by document."""
    rows = mapped(lists_, _entries, "key long, doc long, pivot long, members int")
    to = F.when(F.col("members") == 0, F.xxhash64("key", "doc")).otherwise(F.col("key"))
    return mapped(rows.repartition(to).sortWithinPartitions("key", "doc"), _shared,
                  "key long, doc long, pivot long")
