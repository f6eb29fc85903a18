"""Trie of conversation prefixes from adaptive radix trees.

A turn is a fixed-width id, the first ``ID`` bytes of the SHA-256 of its role
and text, big-endian; a conversation is the byte string of its turns' ids, and
every sequence of first turns that occurs is a node of the trie.

1. Conversations are dealt out by range of ``(key, conv_id)``, so equal ones and
   those with a common first turn spread over many tasks, and a task reads its
   range in order, in *units* of bounded size.
2. A unit is an adaptive radix tree: inner nodes grow through layouts of 4, 16,
   48 and 256 children, runs of bytes without a branch are compressed into one
   path. The tree branches at any byte; only byte depths that are a multiple of
   ``ID`` are nodes of the trie.
3. A node that is no prefix of the unit's first or last key has all its members
   in the unit: it is *closed* and done. The others, at most two paths a unit,
   are *open*: their parts are summed over the units by key, and what hangs
   below them by doubling pointers to ancestors, a logarithm of the depth in
   rounds. Only open nodes are shuffled.
4. The list of ids of an open node's ends is hashed as a stream, from chunks
   already joined by the units; a SHA-256 of one list is sequential by nature.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mapped, saved

ID = 16                  # bytes of a turn's id
UNIT_ROWS = 8_192        # conversations of a unit
UNIT_BYTES = 8 << 20     # their keys' bytes, or one conversation
ROOT = bytes(ID)


class Node:
    """A node of an adaptive radix tree: a compressed path, children in the
    smallest layout that holds them, and the ids whose keys end here."""

    __slots__ = ("path", "keys", "kids", "ends", "sizes", "chain")

    def __init__(self, path: bytes, sizes: list[int]):
        self.path, self.sizes = path, sizes
        self.keys: bytearray | None = bytearray()   # sorted (4, 16), slots by byte (48), none (256)
        self.kids: list = []
        self.ends: list[int] = []
        self.chain = None                             # digests of an open node's prefixes

    @property
    def layout(self) -> int:
        if self.keys is None:
            return 256
        return 48 if len(self.keys) == 256 else 4 if len(self.kids) <= 4 else 16

    def child(self, byte: int):
        if self.keys is None:
            return self.kids[byte]
        if len(self.keys) == 256:
            slot = self.keys[byte]
            return self.kids[slot - 1] if slot else None
        i = bisect_left(self.keys, byte)
        return self.kids[i] if i < len(self.keys) and self.keys[i] == byte else None

    def put(self, byte: int, kid: "Node") -> None:
        """Add or replace a child; a full layout grows into the next one."""
        if self.keys is None:
            self.kids[byte] = kid
        elif len(self.keys) == 256:
            slot = self.keys[byte]
            if slot:
                self.kids[slot - 1] = kid
            elif len(self.kids) < 48:
                self.kids.append(kid)
                self.keys[byte] = len(self.kids)
            else:
                self.kids = [self.kids[s - 1] if s else None for s in self.keys]
                self.keys = None
                self.kids[byte] = kid
        else:
            i = bisect_left(self.keys, byte)
            if i < len(self.keys) and self.keys[i] == byte:
                self.kids[i] = kid
            elif len(self.keys) < 16:
                self.keys.insert(i, byte)
                self.kids.insert(i, kid)
            else:
                slots = bytearray(256)
                for s, b in enumerate(self.keys):
                    slots[b] = s + 1
                self.keys = slots
                self.put(byte, kid)

    def children(self) -> list["Node"]:
        return [k for k in self.kids if k is not None]


def _agree(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo = 0
    while lo + 1 < n:  # a[:lo] agrees, a[:n] does not
        mid = (lo + n) // 2
        lo, n = (mid, n) if a[lo:mid] == b[lo:mid] else (lo, mid)
    return lo


class Tree:
    """Adaptive radix tree of conversations."""

    def __init__(self):
        self.root = Node(b"", [])

    def insert(self, key: bytes, conv: int, sizes: list[int]) -> None:
        above, node, at = None, self.root, 0
        while True:
            n = _agree(node.path, key[at:at + len(node.path)])
            if n < len(node.path):
                upper = Node(node.path[:n], node.sizes)
                upper.put(node.path[n], node)
                node.path = node.path[n + 1:]
                above[0].put(above[1], upper)
                node = upper
            at += n
            if at == len(key):
                node.ends.append(conv)
                return
            kid = node.child(key[at])
            if kid is None:
                kid = Node(key[at + 1:], sizes)
                kid.ends.append(conv)
                node.put(key[at], kid)
                return
            above, node, at = (node, key[at]), kid, at + 1

    def open_path(self, key: bytes, chain: list[bytes]) -> None:
        """Mark the nodes of ``key`` as open; ``chain`` has its prefixes' digests."""
        node, at = self.root, 0
        while True:
            node.chain = chain
            at += len(node.path)
            if at == len(key):
                return
            node, at = node.child(key[at]), at + 1


def _chain(key: bytes) -> list[bytes]:
    """Digest of every prefix of whole turns, the empty one first."""
    out = [ROOT]
    for i in range(0, len(key), ID):
        out.append(hashlib.blake2b(out[-1] + key[i:i + ID], digest_size=ID).digest())
    return out


_COLUMNS = {"conv_id": pa.int64(), "depth": pa.int64(), "parent_conv_id": pa.int64(), "n_convs": pa.int64(),
            "n_children": pa.int64(), "n_leaves": pa.int64(), "saved_tokens": pa.int64(),
            "ends_sha256": pa.string(), "node": pa.binary(), "parent": pa.binary(), "size": pa.int64(),
            "first_end": pa.int64(), "ends": pa.string()}
_SCHEMA = ", ".join(f"{n} {'long' if t == pa.int64() else t}" for n, t in _COLUMNS.items())
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def _unit(rows: list[tuple[int, bytes, list[int]]]) -> list[list]:
    """The trie nodes of a unit, sorted by key and id, as rows of ``_COLUMNS``:
    closed ones whole (``parent`` only where that one is open), open ones
    (``node`` is set) with this unit's part, where children, leaves and saved
    tokens are those of the closed nodes right below."""
    tree = Tree()
    for conv, key, sizes in rows:
        tree.insert(key, conv, sizes)
    for key in {rows[0][1], rows[-1][1]}:
        tree.open_path(key, _chain(key))
    out: list[list] = []
    done: list[tuple] = []  # of finished subtrees: members, least id, closed tops, leaves, saved
    stack = [(tree.root, -1, False)]
    while stack:
        node, start, ready = stack.pop()
        end = start + 1 + len(node.path)
        if not ready:
            stack.append((node, start, True))
            stack.extend((kid, end, False) for kid in node.children())
            continue
        n, least, tops, leaves, saved_ = len(node.ends), min(node.ends, default=None), [], 0, 0
        for _ in node.children():
            m, low, top, leaf, save = done.pop()
            n, leaves, saved_ = n + m, leaves + leaf, saved_ + save
            least = low if least is None else min(least, low)
            tops += top
        # Whole turns that end on this node's path, from below; the root's is byte 0.
        for at in range(end // ID * ID, start, -ID):
            d, ends = at // ID, node.ends if at == end else []
            size = node.sizes[d - 1] if d else 0
            if node.chain is not None:
                for i in tops:
                    out[i][9] = node.chain[d]
                text = ",".join(map(str, ends)) if ends else None
                out.append([least, d, None, n, len(tops), leaves, saved_, None, node.chain[d],
                            node.chain[d - 1] if d else None, size, ends[0] if ends else None, text])
                tops, leaves, saved_ = [], 0, 0
                continue
            for i in tops:
                out[i][2] = least
            leaves, saved_ = leaves or 1, saved_ + (n - 1) * size
            sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest() if ends else _NO_ENDS
            out.append([least, d, None, n, len(tops), leaves, saved_, sha, None, None, None, None, None])
            tops = [len(out) - 1]
        done.append((n, least, tops, leaves, saved_))
    return out


def _parts(batches):
    """Rows of the units of a task, from ``(conv_id, key, sizes)`` in order."""
    def table(rows):
        cols = list(zip(*rows)) or [()] * len(_COLUMNS)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _COLUMNS.values())],
                                          list(_COLUMNS))
    held, size = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            held.append(row)
            size += len(row[1])
            if len(held) == UNIT_ROWS or size >= UNIT_BYTES:
                yield table(_unit(held))
                held, size = [], 0
    if held:
        yield table(_unit(held))


def _hashed(batches):
    """``(node, ends_sha256)`` from chunks ``(node, first_end, ends)`` in order."""
    node, sha = None, None
    for batch in batches:
        out = []
        for at, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if at == node:
                sha.update(b",")
            else:
                if sha:
                    out.append((node, sha.hexdigest()))
                node, sha = at, hashlib.sha256()
            sha.update(text.encode())
        cols = list(zip(*out)) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.string())],
                                         ["node", "ends_sha256"])
    if sha:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([sha.hexdigest()])],
                                         ["node", "ends_sha256"])


def turn_ids(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """``(conv_id, turn, id, size)`` per row: the turn's id and its text's UTF-8
    bytes (null role or text: empty). Rows without a conversation id belong to
    no conversation. Texts go no further than this step."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    framed = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.unhex(F.substring(F.sha2(framed, 256), 1, 2 * ID)).alias("id"),
        F.octet_length(text).cast("long").alias("size"))


def _key(turns: Column) -> list[Column]:
    return [F.unhex(F.array_join(F.transform(turns, lambda t: F.hex(t["id"])), "")).alias("key"),
            F.transform(turns, lambda t: t["size"]).alias("sizes")]


def _ordered(ids: DataFrame, by: Column) -> DataFrame:
    """One row per ``by``: its turns in order (equal or null turn numbers by id)."""
    turn = F.struct("conv_id", F.col("turn").isNotNull().alias("known"), "turn", "id", "size")
    return ids.groupBy(by.alias("group")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def conversation_keys(turns: DataFrame, **columns: str) -> DataFrame:
    """``(conv_id, key, sizes)`` of every conversation as it stands."""
    rows = _ordered(turn_ids(turns, **columns), F.col("conv_id"))
    return rows.select(F.col("group").alias("conv_id"), *_key(F.col("turns")))


def regrafted_keys(turns: DataFrame, *, family: int = 5, modulus: int = 9, **columns: str) -> DataFrame:
    """``(conv_id, key, sizes)`` of every conversation ``c`` rebuilt: the first
    ``h`` turns of conversation ``c - c % family`` (all if fewer, none if there
    is none; ``%`` takes the sign of ``c``), then ``c``'s own after its first
    ``h``; ``h`` is the unsigned CRC-32 of the decimal ``c``, modulo ``modulus``.
    One shuffle of ids: a family meets in one row."""
    conv = F.col("conv_id")
    rows = _ordered(turn_ids(turns, **columns), conv - conv % family)
    rows = rows.withColumn("conv_id", F.explode(F.array_distinct(F.transform("turns", lambda t: t["conv_id"]))))
    h = (F.crc32(conv.cast("string").cast("binary")) % modulus).cast("int")
    own = lambda c: F.filter("turns", lambda t: t["conv_id"] == c)
    rows = rows.select("conv_id", h.alias("h"), own(F.col("group")).alias("first"), own(conv).alias("own"))
    return rows.select("conv_id", F.concat(
        F.slice("first", F.lit(1), F.col("h")), F.slice("own", F.col("h") + 1, F.size("own"))).alias("turns")
    ).select("conv_id", *_key(F.col("turns")))


def prefix_trie(keys: DataFrame) -> DataFrame:
    """The trie of ``(conv_id, key, sizes)`` rows, one per conversation: a row
    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256)`` per node. ``conv_id`` is the smallest member,
    ``n_leaves`` and ``saved_tokens`` cover the node's subtree.

    A conversation without turns is a member of the root alone; no
    conversations, no nodes. Conversations may be equal in any number. One
    conversation must fit into a row.
    """
    keys = saved(keys.select("conv_id", "key", "sizes"), "keys")
    dealt = keys.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    parts = saved(mapped(dealt, _parts, _SCHEMA), "units")
    result = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]

    some = parts.where("node is not null")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    open_ = saved(some.groupBy("node").agg(F.first("parent").alias("parent"), F.first("depth").alias("depth"),
                                           F.min("conv_id").alias("conv_id"), F.first("size").alias("size"), *sums),
                  "open")
    kids = open_.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("more"))
    open_ = saved(open_.join(kids, "node", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).select(
        "node", "parent", "depth", "conv_id", "n_convs", "n_children",
        (F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens")), "open")
    # Subtree sums: `up` is the ancestor 2**round above, the sums cover what is nearer.
    total = open_.select("node", F.col("parent").alias("up"), "n_leaves", "saved_tokens")
    while True:
        going = total.where("up is not null")
        if going.isEmpty():
            break
        add = going.groupBy(F.col("up").alias("node")).agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
        higher = total.select(F.col("node").alias("up"), F.col("up").alias("higher"))
        moved = (going.join(higher, "up").select("node", F.col("higher").alias("up"), "n_leaves", "saved_tokens")
                 .union(total.where("up is null")))
        total = saved(moved.join(add, "node", "left").select(
            "node", "up", (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("s", F.lit(0))).alias("saved_tokens")), "sums")

    ends = some.where("ends is not null").select("node", "first_end", "ends")
    ends = mapped(ends.repartition("node").sortWithinPartitions("node", "first_end"), _hashed,
                  "node binary, ends_sha256 string")
    over = open_.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    tops = (open_.drop("n_leaves", "saved_tokens").join(total.drop("up"), "node").join(ends, "node", "left")
            .join(over, "parent", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS))))
    closed = parts.where("node is null")
    below = closed.where("parent is not null").drop("parent_conv_id").join(over, "parent")
    return (closed.where("parent is null").select(*result).union(below.select(*result))
            .union(tops.select(*result)))
