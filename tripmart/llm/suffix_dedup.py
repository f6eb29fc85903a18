"""Repeated passages by sparse suffix arrays.

Of all suffixes of a text only those at content-selected places are kept: the
place of the least hash among the ``LENGTH - K + 1`` k-word grams of each
``LENGTH``-word window (its minimiser). Equal windows select the same place, so
a passage of ``LENGTH`` words or more that occurs twice has equal suffixes kept
in both. Three steps follow:

1. *Sort, compare neighbours.* Kept suffixes are sorted by the hash of their
   first ``K`` words; a suffix whose neighbours differ is alone and is dropped.
2. *Extend.* From each suffix left, the match is extended to the left and to the
   right over the windows that selected it; the windows' hashes are sorted and
   neighbours compared again, which gives each window's first occurrence.
3. *Spans.* Overlapping windows of a document join to maximal spans.

A window's first occurrence (by document id, null last, then place) stays; words of its
later occurrences are cut unless they belong to a first occurrence as well.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U, Text, byte_hash, lists, mapped, maybe_in, prefix, run_hash, saved, shared_keys, texts

LENGTH = 50
K = 20
COMBINED = 1 << 19   # windows that are combined before the shuffle
_LAST = (1 << 63) - 1  # stands for a null id: after all others


def _windows(t: Text) -> tuple[np.ndarray, ...]:
    """First word, document and hash of every window; hash of the gram that the
    window selects (the leftmost of equal ones) and its place."""
    start, end, doc = t.words()
    at = t.bounds(doc)
    sums = prefix(byte_hash(t.data, start, end))
    first = np.arange(max(0, len(doc) - LENGTH + 1))
    first = first[first + LENGTH <= at[doc[first] + 1]] if len(first) else first
    if not len(first):
        return first, first, np.empty(0, U), np.empty(0, U), first
    gram = np.arange(len(doc) - K + 1)
    g = run_hash(sums, gram, gram + K)
    # Least gram of each window, by doubling: minima over 2, 4, ... grams.
    width, least, place, size = LENGTH - K + 1, g, gram, 1

    def lower(i, j):
        right = least[j] < least[i]
        return np.where(right, least[j], least[i]), np.where(right, place[j], place[i])

    while 2 * size <= width:
        least, place = lower(slice(None, -size), slice(size, None))
        size *= 2
    least, place = lower(first, first + width - size)
    return first - at[doc[first]], doc[first], run_hash(sums, first, first + LENGTH), least, place


def _anchors(batches):
    """From ``(doc, tag, key, text)``: number of words and hashes of the kept
    suffixes' first grams."""
    for batch in batches:
        keys, many, words = [], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for t in texts(batch.column(3)):
            _, doc, _, gram, place = _windows(t)
            # A place selected by several windows in a row counts once.
            new = np.ones(len(gram), bool)
            new[1:] = place[1:] != place[:-1]
            keys.append(gram[new])
            many.append(np.bincount(doc[new], minlength=len(t)))
            words.append(np.bincount(t.words()[2], minlength=len(t)))
        flat = np.concatenate([np.empty(0, U), *keys])
        at = np.append(0, np.cumsum(np.concatenate(many)))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(np.concatenate(words).astype(np.int64)),
             lists(flat.view(np.int64), at)], ["doc", "tag", "key", "n", "keys"])


def _extended(batches):
    """From ``(doc, tag, text, keys)`` the windows ``(key, doc, tag, place, members)``
    around the suffixes in ``keys``. Equal ones of ``COMBINED`` windows and more
    in a row are combined: the first goes on with their number, the others
    (members 0) are known to be later occurrences."""
    parts, n = [], 0
    for batch in batches:
        docs, tags = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        wanted = batch.column(3)
        for t in texts(batch.column(2)):
            word, doc, h, gram, _ = _windows(t)
            at = t.bounds(doc)
            keep = np.zeros(len(doc), bool)
            for d in range(len(t)):
                some = wanted[t.first + d].values.to_numpy(zero_copy_only=False).view(U)
                keep[at[d]:at[d + 1]] = np.isin(gram[at[d]:at[d + 1]], some)
            row = t.first + doc[keep]
            parts.append((h[keep].view(np.int64), docs[row], tags[row], word[keep]))
            n += len(row)
            if n >= COMBINED:
                yield _combined(parts)
                parts, n = [], 0
    if parts:
        yield _combined(parts)


def _combined(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    key, doc, tag, place = (np.concatenate(x) for x in zip(*parts))
    by = np.lexsort((place, tag, doc, key))
    key, doc, tag, place = key[by], doc[by], tag[by], place[by]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(new)
    members = np.zeros(len(key), np.int32)
    members[first] = np.diff(np.append(first, len(key)))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (key, doc, tag, place, members)],
                                      ["key", "doc", "tag", "place", "members"])


def _neighbours(batches):
    """From windows sorted by (key, doc, tag, place): ``(doc, tag, place, first)``
    of those that occur twice or more. Streams; one row is carried from batch to
    batch."""
    names = ["doc", "tag", "place", "first"]
    held = None  # key, doc, tag, place, several, first
    for batch in batches:
        key, doc, tag, place, members = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        rest = members == 0
        out = [(doc[rest], tag[rest], place[rest], np.zeros(rest.sum(), bool))]
        now = [x[~rest] for x in (key, doc, tag, place)] + [members[~rest] > 1]
        if len(now[0]):
            if held:
                now = [np.append(h, x) for h, x in zip(held, now)]
            key, doc, tag, place, several = now
            same = key[1:] == key[:-1]
            first = np.append(held[5] if held else True, ~same)
            several[1:] |= same
            several[:-1] |= same
            some = several[:-1]
            out.append((doc[:-1][some], tag[:-1][some], place[:-1][some], first[:-1][some]))
            held = key[-1], doc[-1], tag[-1], place[-1], several[-1], first[-1]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names)
    if held and held[4]:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*held[1:4], bool(held[5]))], names)


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


def _cover(first: np.ndarray, n: int) -> np.ndarray:
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, first + LENGTH, -1)
    return np.cumsum(step[:-1]) > 0


def _spans(batches):
    """From ``(doc, tag, n, copy, copied, later, first)`` the spans of each
    document as lists of first words, lengths and whether they are kept."""
    for batch in batches:
        out = []
        for _, _, n, copy, copied, later, first in zip(*(c.to_pylist() for c in batch.columns)):
            later, first = np.array(later or [], np.int64), np.array(first or [], np.int64)
            if copy:
                keep, cut = np.zeros(n, bool), np.ones(n, bool)
            else:
                if copied:  # its other windows come again in the copies
                    first = np.setdiff1d(np.arange(n - LENGTH + 1), later)
                keep, cut = _cover(first, n), _cover(later, n)
                cut &= ~keep
            (a, b), (x, y) = _runs(cut), _runs(keep)
            out.append(([*a.tolist(), *x.tolist()], [*(b - a).tolist(), *(y - x).tolist()],
                        [False] * len(a) + [True] * len(x)))
        cols = list(zip(*out)) or [[]] * 3
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(cols[0], pa.list_(pa.int64())),
             pa.array(cols[1], pa.list_(pa.int64())), pa.array(cols[2], pa.list_(pa.bool_()))],
            ["doc", "tag", "n", "start", "words", "kept"])


def _without(batches):
    """From ``(text, n, start, words, ...)`` the texts without those words, each up
    to the next kept word; then the other columns. A text that has not ``n`` words
    is not the one that the places belong to."""
    for batch in batches:
        out = []
        for t in texts(batch.column(0)):
            first, _, doc = t.words()
            at = t.bounds(doc)
            for d in range(len(t)):
                raw = t.data[t.off[d]:t.off[d + 1]].tobytes()
                places = np.append(first[at[d]:at[d + 1]] - t.off[d], len(raw)).tolist()
                size, a, n = (batch.column(i)[t.first + d].as_py() for i in (1, 2, 3))
                if a and size != len(places) - 1:
                    raise ValueError(f"a text of {len(places) - 1} words has the tag of one of {size}")
                left, end = [], 0
                for i, k in zip(a or [], n or []):
                    left.append(raw[end:places[i]])
                    end = places[i + k]
                out.append(b"".join([*left, raw[end:]]).decode())
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), *batch.columns[4:]],
                                         ["_text", *batch.schema.names[4:]])


def _identity(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc, tag, key, text)``; rows equal in id and text are one document.
    ``key`` finds a document's suffixes again; a key that documents share only
    makes them look for the others' suffixes as well."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    doc, tag = _place(docs, id_col, text_col)
    return docs.select(doc.alias("doc"), tag.alias("tag"),
                       F.when(F.col(id_col).isNull(), F.xxhash64(tag)).otherwise(doc).alias("key"), text.alias("text"))


def _place(docs: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column]:
    """A row's id, the last number for null, and 63 bits of its text's hash; the
    lowest bit of these says that the id is null."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    ident = F.col(id_col).cast("long")
    none = ident.isNull().cast("long")
    return F.coalesce(ident, F.lit(_LAST)), F.xxhash64(text).bitwiseAND(-2).bitwiseOR(none)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, tag, n_words, spans)`` of the documents that hold a passage found
    twice or more: an array of ``(start_word, n_words, kept)``, first the later
    occurrences (to be cut), then the first occurrences (``kept``). ``tag`` is
    a hash of the text and tells apart rows that share an id or have none.

    A passage has ``LENGTH`` words at least; words are compared as they stand,
    white space between them is not. Equal texts are one document with the
    smallest id; the others are later occurrences as a whole. Rows equal in id
    and text are one document. Rows with a null id come after all others; a
    null, empty or short text has no passage; other columns are ignored.

    A text that many rows share is extended once; a gram or window that very
    many documents share is combined per batch before the shuffle and never held
    as a group. The windows found in a document are collected per document.
    """
    base = _identity(docs, id_col, text_col)
    sha = F.sha2("text", 256)
    same = saved(base.where(F.octet_length("text") >= 2 * LENGTH - 1).groupBy(sha.alias("sha"))
                 .agg(F.min("doc").alias("rep"), F.max("doc").alias("most")).where("rep < most")
                 .select("sha", "rep"), "same")
    marks = saved(base.select("doc", "tag", sha.alias("sha")).join(same, "sha")
                  .select("doc", "tag", "rep").distinct(), "copies")
    anchors = saved(mapped(base, _anchors, "doc long, tag long, key long, n long, keys array<long>"), "suffixes")
    # Step 1: suffixes of distinct texts that have an equal neighbour.
    some = (anchors.where(F.size("keys") > 0).select("doc", "tag", "key", "keys").dropDuplicates(["doc", "tag"])
            .join(marks.where("doc <> rep").select("doc", "tag"), ["doc", "tag"], "left_anti"))
    keys = saved(shared_keys(some.select(F.col("key").alias("doc_id"), "keys"))
                 .groupBy(F.col("doc").alias("key")).agg(F.collect_set("key").alias("keys")), "anchors")
    # Step 2: their windows, and which of them come first.
    _, near = maybe_in(base, F.col("key"), keys.select("key"))
    wide = mapped(near.drop("key").join(some.select("doc", "tag", "key").join(keys, "key"), ["doc", "tag"])
                  .dropDuplicates(["doc", "tag"]).select("doc", "tag", "text", "keys"),
                  _extended, "key long, doc long, tag long, place long, members int")
    to = F.when(F.col("members") == 0, F.xxhash64("key", "doc", "tag", "place")).otherwise(F.col("key"))
    found = mapped(wide.repartition(to).sortWithinPartitions("key", "doc", "tag", "place"), _neighbours,
                   "doc long, tag long, place long, first boolean")
    per_doc = saved(found.groupBy("doc", "tag").agg(
        F.collect_list(F.when(~F.col("first"), F.col("place"))).alias("later"),
        F.collect_list(F.when(F.col("first"), F.col("place"))).alias("first")), "windows")
    # Step 3.
    size = anchors.where(f"n >= {LENGTH}").select("doc", "tag", "n").distinct()
    marked = (per_doc.join(marks, ["doc", "tag"], "full").join(size, ["doc", "tag"])
              .select("doc", "tag", "n", F.coalesce(F.col("doc") > F.col("rep"), F.lit(False)).alias("copy"),
                      F.col("rep").isNotNull().alias("copied"), "later", "first"))
    spans = F.transform(F.arrays_zip("start", "words", "kept"), lambda z: F.struct(
        z["start"].alias("start_word"), z["words"].alias("n_words"), z["kept"].alias("kept")))
    return saved(mapped(
        marked, _spans, "doc long, tag long, n long, start array<long>, words array<long>, kept array<boolean>")
        .select(F.when(F.col("tag").bitwiseAND(1) == 0, F.col("doc")).alias("doc_id"), "tag",
                F.col("n").alias("n_words"), spans.alias("spans")), "spans")


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the later occurrences of ``repeats`` cut from ``text_col``
    and ``cut_words``, the number of words cut from the row (a column of that
    name is replaced). Every row stays, with an empty text if all is cut."""
    spans = repeats(docs, id_col, text_col).withColumn("cut", F.filter("spans", lambda s: ~s["kept"]))
    spans = spans.where(F.size("cut") > 0).select(
        F.coalesce("doc_id", F.lit(_LAST)).alias("_doc"), F.col("tag").alias("_tag"), F.col("n_words").alias("_words"), "cut")
    spans = saved(spans, "cuts")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keep = [c for c in docs.columns if c not in (text_col, "cut_words")]
    doc, tag = _place(docs, id_col, text_col)
    on = (doc == F.col("_doc")) & (tag == F.col("_tag"))
    apart, near = maybe_in(docs, tag, spans.select("_tag"))
    cut = F.aggregate("_n", F.lit(0).cast("long"), lambda x, y: x + y)
    rows = near.join(spans, on, "left").withColumns({"_start": F.col("cut.start_word"), "_n": F.col("cut.n_words")}).select(
        text.alias("_old"), "_words", "_start", "_n", F.coalesce(cut, F.lit(0).cast("long")).alias("_cut"),
        F.col(text_col).isNull().alias("_none"), *keep)
    kinds = ", ".join(["_text string", "_cut long", "_none boolean",
                       *(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields)])
    new = mapped(rows, _without, kinds).select(
        *keep, F.when(~F.col("_none"), F.col("_text")).alias(text_col), F.col("_cut").alias("cut_words"))
    order = [*docs.columns, "cut_words"] if "cut_words" not in docs.columns else docs.columns
    apart = apart.select(*keep, F.col(text_col).cast("string").alias(text_col),
                         F.lit(0).cast("long").alias("cut_words"))
    return apart.union(new).select(*order)
