"""Quality rules by repetition coverage.

Every text is read as a sequence of words and of lines. Rolling hashes of
several n-gram lengths (numpy, over the whole text) find the n-grams and lines
that occur more than once; the rules bound the share of characters inside them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Text, U, byte_hash, mapped, mix, prefix, run_hash, texts

WINDOW = 8             # words of the base rule's windows
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
# Largest share (percent) of word characters inside n-grams found twice or more.
MAX_DUP_PCT = {5: 45, 6: 42, 7: 39, 8: 36, 9: 33, 10: 30}
# Largest share (percent) of word characters inside lines equal to an earlier
# line, and of such lines.
MAX_LINE_CHAR_PCT = 30
MAX_LINE_PCT = 40

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_NEWLINE = np.zeros(256, bool)
_NEWLINE[0x0A] = True

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_MORE = ["n_lines", "dup_line_chars", *(f"dup_chars_{k}" for k in MAX_DUP_PCT)]


def _again(h: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which entries have an equal entry in the same document."""
    key = mix(h ^ mix(owner.astype(U)))
    s = np.sort(key)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return np.zeros(len(key), bool)
    at = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    return twice[at] == key


def _covered(first: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in one of the ``k``-word windows at ``first``."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, first + k, -1)
    return np.cumsum(step[:-1]) > 0


def measure(t: Text) -> dict[str, np.ndarray]:
    """The counts of each document of ``t``."""
    start, end, doc = t.words()
    n = len(t)
    per_doc = lambda who, what=None: np.bincount(who, what, n).astype(np.int64)
    points = np.zeros(len(t.data) + 1, np.int64)  # code points before each byte
    np.cumsum((t.data & 0xC0) != 0x80, out=points[1:])
    chars = points[end] - points[start]
    out = {"n_words": per_doc(doc), "word_chars": per_doc(doc, chars)}
    symbols = np.flatnonzero(_SYMBOL[t.data])
    out["n_symbols"] = per_doc(np.searchsorted(t.off, symbols, "right") - 1)
    raw = byte_hash(t.data, start, end)
    sums = prefix(raw)
    at = t.bounds(doc)
    for k in sorted({WINDOW, *MAX_DUP_PCT}):
        first = np.arange(max(0, len(doc) - k + 1))
        first = first[first + k <= at[doc[first] + 1]]
        twice = first[_again(run_hash(sums, first, first + k), doc[first])]
        inside = _covered(twice, k, len(doc))
        if k == WINDOW:
            out["n_repeat_words"] = per_doc(doc[inside])
        if k in MAX_DUP_PCT:
            out[f"dup_chars_{k}"] = per_doc(doc[inside], chars[inside])
    # Lines: runs between newlines that hold a word.
    a, b, who = t.spans(_NEWLINE[t.data])
    word = np.searchsorted(start, a), np.searchsorted(start, b)
    some = word[0] < word[1]
    a, b, who, word = a[some], b[some], who[some], (word[0][some], word[1][some])
    h = mix(byte_hash(t.data, a, b) ^ mix(who.astype(U)))
    order = np.argsort(h, kind="stable")
    later = np.zeros(len(h), bool)
    later[order[1:]] = h[order][1:] == h[order][:-1]
    total = np.append(0, np.cumsum(chars))
    out["n_lines"] = per_doc(who)
    out["n_dup_lines"] = per_doc(who[later])
    out["dup_line_chars"] = per_doc(who[later], (total[word[1]] - total[word[0]])[later])
    return out


def _measure(batches):
    for batch in batches:
        parts = [measure(t) for t in texts(batch.column(0))]
        cols = [np.concatenate([p[c] for p in parts]) if parts else np.empty(0, np.int64)
                for c in _COUNTS + _MORE]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:], *(pa.array(c, pa.int64()) for c in cols)],
            [*batch.schema.names[1:], *_COUNTS, *_MORE])


def quality(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with its counts and the verdicts ``base_failed`` and ``kept``.

    A row fails the base rule with fewer than ``MIN_WORDS`` words or more than
    ``MAX_REPEAT_PCT`` % of its words in repeated 8-word windows. It is kept if
    it passes that and every coverage bound. A null, empty or blank text has no
    words and fails. Each row is judged on its own: ties and repeated rows do
    not matter, and an empty table stays empty. Columns of ``docs`` named like
    an added column are replaced; all others pass through unread. No shuffle.
    """
    names = [*_COUNTS, *_MORE, "base_failed", "kept"]
    rest = [c for c in docs.columns if c not in names]
    # The text travels twice only if it is kept as a column of the result.
    schema = docs.select(F.col(text_col).cast("string").alias("_quality_text"), *rest)
    out = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.schema.fields[1:]),
                     *(f"{c} long" for c in _COUNTS + _MORE)])
    got = mapped(schema, _measure, out)
    failed = (F.col("n_words") < MIN_WORDS) | \
        (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    fine = ~failed
    for k, most in MAX_DUP_PCT.items():
        fine &= 100 * F.col(f"dup_chars_{k}") <= most * F.col("word_chars")
    fine &= 100 * F.col("dup_line_chars") <= MAX_LINE_CHAR_PCT * F.col("word_chars")
    fine &= 100 * F.col("n_dup_lines") <= MAX_LINE_PCT * F.col("n_lines")
    return got.select("*", failed.alias("base_failed"), fine.alias("kept"))
