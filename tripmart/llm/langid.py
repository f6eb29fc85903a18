"""Language labels by a linear-chain conditional random field.

Every word of a text has a label; a word's score for a label is the sum of the
weights of its features (prefixes and suffixes, character n-grams, the word
itself as a lexicon entry, all hashed), and neighbouring labels have learned
transition scores, so text that switches between languages is labelled word by
word. The model maximises the likelihood of word labels by forward-backward and
Adagrad. Training sequences join pieces of different documents, so switches are
seen. A text's label is the one with the largest summed posterior.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Text, U, byte_hash, byte_sums, mapped, mix, run_hash, saved, texts

DOCS_PER_LABEL = 300   # bound of the training sample
FAN_IN = 16            # groups whose first rows are ranked together
PIECES = 4             # pieces of a sampled text
PIECE_WORDS = 32       # words of a piece
BITS = 15              # weights per feature kind, as a power of two
AFFIX = 4              # longest prefix and suffix, in bytes
NGRAMS = (2, 3)
EPOCHS = 4
BATCH = 128
RATE = 0.5
DECAY = 1e-4
FLUSH_WORDS = 1_000_000  # words whose scores are held at once
UNKNOWN = "und"

_KINDS = 2 * AFFIX + 1 + len(NGRAMS)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def held_out(doc_id: Column) -> Column:
    """Documents of the test quarter; a null id is not one."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def features(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weight rows of words: ``(word, row, value)`` triples, sorted by word."""
    sums = byte_sums(data)
    slot = lambda h, kind: (mix(h + U(kind)) >> U(64 - BITS)).astype(np.int64) + (kind << BITS)
    n = len(start)
    word, row, value = [], [], []
    for k in range(1, AFFIX + 1):
        word += [np.arange(n)] * 2
        row += [slot(run_hash(sums, start, np.minimum(start + k, end)), 2 * k - 2),
                slot(run_hash(sums, np.maximum(end - k, start), end), 2 * k - 1)]
        value += [np.ones(n, np.float32)] * 2
    word.append(np.arange(n))
    row.append(slot(run_hash(sums, start, end), 2 * AFFIX))
    value.append(np.ones(n, np.float32))
    for i, k in enumerate(NGRAMS):
        many = np.maximum(end - start - k + 1, 0)
        of = np.repeat(np.arange(n), many)
        at = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many) + start[of]
        word.append(of)
        row.append(slot(run_hash(sums, at, at + k), 2 * AFFIX + 1 + i))
        value.append((1 / np.sqrt(many[of])).astype(np.float32))
    word = np.concatenate(word)
    by = np.argsort(word, kind="stable")
    return word[by], np.concatenate(row)[by], np.concatenate(value)[by]


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray      # feature row x label
    switch: np.ndarray       # label before x label

    def scores(self, t: Text) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores and document of every word of ``t``, and which have letters."""
        start, end, doc = t.words()
        if not len(start):
            return np.empty((0, len(self.labels)), np.float32), doc, np.empty(0, bool)
        h, first, which = np.unique(byte_hash(t.data, start, end), return_index=True, return_inverse=True)
        letters = np.append(0, np.cumsum(_LETTER[t.data]))
        spelled = (letters[end] > letters[start])[first]
        out = emissions(self.weights, *features(t.data, start[first], end[first]), len(h))
        out[~spelled] = 0
        return out[which], doc, spelled[which]


def emissions(weights: np.ndarray, word: np.ndarray, row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    at = np.searchsorted(word, np.arange(n))
    return np.add.reduceat(weights[row] * value[:, None], at, axis=0).astype(np.float32)


def posteriors(scores: np.ndarray, length: np.ndarray, switch: np.ndarray, pairs: bool = False):
    """Forward-backward over sequences that follow one another in ``scores``.

    Returns the posterior of every label at every word and, with ``pairs``, the
    expected transitions. Sequences run side by side, the longest first, so each
    step works on all that are long enough.
    """
    n, labels = scores.shape
    rank = np.argsort(-length, kind="stable")
    longest = int(length.max(initial=0))
    active = np.searchsorted(-length[rank], -np.arange(longest), "left")  # sequences longer than t
    off = np.append(0, np.cumsum(active))
    place = np.empty(len(length), np.int64)
    place[rank] = np.arange(len(length))
    t = np.arange(n) - np.repeat(np.cumsum(length) - length, length)
    at = off[t] + np.repeat(place, length)
    e = np.empty_like(scores)
    e[at] = np.exp(scores - scores.max(1, keepdims=True))
    a = np.exp(switch).astype(scores.dtype)
    alpha = e.copy()
    if n:
        x = alpha[:off[1]]
        x /= x.sum(1, keepdims=True)
    for s in range(1, longest):
        x = alpha[off[s]:off[s + 1]]
        x *= alpha[off[s - 1]:off[s - 1] + len(x)] @ a
        x /= x.sum(1, keepdims=True)
    beta = np.ones((active[0] if longest else 0, labels), scores.dtype)
    expected = np.zeros((labels, labels))
    post = alpha
    for s in range(longest - 1, -1, -1):
        x = alpha[off[s]:off[s + 1]]
        if s + 1 < longest:
            k = off[s + 2] - off[s + 1]
            right = e[off[s + 1]:off[s + 2]] * beta[:k]
            if pairs:
                both = x[:k, :, None] * a * right[:, None, :]
                expected += (both / both.sum((1, 2), keepdims=True)).sum(0)
            new = right @ a.T
            beta[:k] = new / new.sum(1, keepdims=True)
        x *= beta[:len(x)]
        x /= x.sum(1, keepdims=True)
    return post[at], expected


def train(pieces: list[tuple[str, bytes]], seed: int = 5) -> Model | None:
    """Fit the field to ``(label, piece of text)`` rows; None without any."""
    labels = sorted({y for y, _ in pieces})
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    data = np.frombuffer(b"".join(p for _, p in pieces), np.uint8)
    t = Text(0, data, np.append(0, np.cumsum([len(p) for _, p in pieces])))
    start, end, doc = t.words()
    at = t.bounds(doc)
    h, first, which = np.unique(byte_hash(data, start, end), return_index=True, return_inverse=True)
    word, row, value = features(data, start[first], end[first])
    begin = np.searchsorted(word, np.arange(len(h) + 1))
    truth = np.array([labels.index(y) for y, _ in pieces])
    weights = np.zeros((_KINDS << BITS, len(labels)), np.float32)
    squares = np.full_like(weights, 1e-2)
    switch, switch_squares = np.zeros((len(labels),) * 2), np.full((len(labels),) * 2, 1e-2)
    for _ in range(EPOCHS):
        order = rng.permutation(len(pieces))
        for batch in np.split(order, range(BATCH, len(order), BATCH)):
            words = np.concatenate([np.arange(at[p], at[p + 1]) for p in batch])
            size = at[batch + 1] - at[batch]
            y = np.repeat(truth[batch], size)
            # Sequences of one to three pieces each.
            groups = np.cumsum(rng.random(len(batch)) < 0.5)
            length = np.bincount(groups, size, groups[-1] + 1).astype(np.int64)
            length = length[length > 0]
            if not len(words):
                continue
            used, back = np.unique(which[words], return_inverse=True)
            many = begin[used + 1] - begin[used]
            flat = np.repeat(begin[used] - np.cumsum(many) + many, many) + np.arange(many.sum())
            own, val = np.repeat(np.arange(len(used)), many), value[flat]
            score = emissions(weights, own, row[flat], val, len(used))
            post, expected = posteriors(score[back], length, switch, pairs=True)
            post[np.arange(len(y)), y] -= 1
            per_word = np.stack([np.bincount(back, post[:, k], len(used)) for k in range(len(labels))], 1)
            rows, slot = np.unique(row[flat], return_inverse=True)
            grad = np.stack([np.bincount(slot, per_word[own, k] * val, len(rows))
                             for k in range(len(labels))], 1) + DECAY * weights[rows]
            squares[rows] += grad ** 2
            weights[rows] -= RATE * grad / np.sqrt(squares[rows])
            inner = np.ones(len(y) - 1, bool)
            inner[np.cumsum(length)[:-1] - 1] = False
            seen = np.zeros_like(switch)
            np.add.at(seen, (y[:-1][inner], y[1:][inner]), 1)
            grad = expected - seen + DECAY * switch
            switch_squares += grad ** 2
            switch -= RATE * grad / np.sqrt(switch_squares)
    return Model(labels, weights, switch.astype(np.float32))


def _pieces(batches):
    """Up to ``PIECES`` pieces of ``PIECE_WORDS`` words, spread over each text."""
    for batch in batches:
        out = []
        for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
            words = (text or "").lower().encode().split()
            step = max(PIECE_WORDS, len(words) // PIECES)
            for i in range(0, len(words), step):
                out.append((lang, b" ".join(words[i:i + PIECE_WORDS]) + b"\n"))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.binary())],
            ["lang", "piece"])


def _least(rows: DataFrame, one: list[str], order: list) -> DataFrame:
    """The first ``DOCS_PER_LABEL`` rows of each label in ``order``, found in a
    tournament: each task keeps its own first rows, then groups of ``FAN_IN``
    tasks theirs, and so on. However many rows a label has, no task ranks more
    than ``FAN_IN * DOCS_PER_LABEL`` of it that other tasks have kept. The groups
    decide where rows meet, not which ones stay."""
    rows = rows.withColumn("g", F.spark_partition_id())
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        last = tasks <= FAN_IN
        rows = rows.withColumn("g", F.lit(0) if last else F.expr(f"int(g div {FAN_IN})"))
        place = F.row_number().over(Window.partitionBy("lang", "g").orderBy(*order))
        rows = rows.withColumn("r", place).where(F.col("r") <= DOCS_PER_LABEL).select(*one, "g")
        if last:
            return rows.drop("g")
        tasks = -(-tasks // FAN_IN)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """The model of ``docs``: learned from a sample of at most ``DOCS_PER_LABEL``
    documents per label, those with the least hash of their id, among documents
    with an id, a text and a label that are not held out. Rows equal in id, label
    and text are one document. Labels are few by nature; the sample's pieces are
    collected and fitted on the driver."""
    ident = F.col(id_col)
    known = docs.where(ident.isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
                       & ~held_out(ident)).select(ident.alias("id"), F.col(lang_col).cast("string").alias("lang"),
                                                  F.col(text_col).cast("string").alias("text"))
    known, one = known.withColumn("h", F.xxhash64("text")), ["lang", "id", "h"]
    some = _least(known.select(*one).distinct(), one, [F.xxhash64("id"), F.col("id"), F.col("h")])
    some = saved(some, "sample")
    rows = known.join(some, one, "left_semi").groupBy(*one).agg(F.min("text").alias("text")).select("lang", "text")
    got = rows.mapInArrow(_pieces, "lang string, piece binary").collect()
    return train(sorted((r[0], bytes(r[1])) for r in got))


def _predict(model: Model | None):
    def judged(batch: pa.RecordBatch):
        label, score = [], []

        def flush():
            if not held:
                return
            s = np.concatenate([h[0] for h in held])
            spelled = np.concatenate([h[1] for h in held])
            length = np.concatenate([h[2] for h in held])
            post, _ = posteriors(s, length, model.switch)
            owner = np.repeat(np.arange(len(length)), length)[spelled]
            total = np.stack([np.bincount(owner, post[spelled, k], len(length))
                              for k in range(len(model.labels))], 1)
            best = total.argmax(1)
            share = total.max(1) / np.maximum(np.bincount(owner, minlength=len(length)), 1)
            label.extend(best.tolist())
            score.extend(np.clip(share, 0, 1).tolist())
            held.clear()

        held: list = []
        count = 0
        for t in texts(batch.column(0), lower=True):
            s, doc, spelled = model.scores(t)
            held.append((s, spelled, np.bincount(doc, minlength=len(t))))
            count += len(s)
            if count >= FLUSH_WORDS:
                flush()
                count = 0
        flush()
        return label, score

    def run(batches):
        letter = re.compile(r"[^\W\d_]")
        for batch in batches:
            label, score = judged(batch) if model else ([0] * batch.num_rows, [0.0] * batch.num_rows)
            col, out = batch.column(0), []
            for i in range(batch.num_rows):
                text = col[i].as_py()
                named = model and text and (m := letter.search(text)) and (m[0].isalpha() or any(map(str.isalpha, text)))
                out.append(model.labels[label[i]] if named else UNKNOWN)
                score[i] = float(score[i]) if named else 0.0
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(out, pa.string()),
                                              pa.array(score, pa.float64())],
                                             [*batch.schema.names[1:], "lang_pred", "score"])
    return run


def label_languages(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``lang_pred`` and ``score``: the label with
    the largest mean posterior over the words of the whole text, and that mean.

    A null text, a text without a letter, or a model of no labels gives ``und``
    and 0. Only the text is looked at. Columns named like an added one are
    replaced; repeated rows are each judged; no shuffle. The field runs over the
    whole text, however long.
    """
    keep = [c for c in docs.columns if c not in (text_col, "lang_pred", "score")]
    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields),
                       "lang_pred string", "score double"])
    return mapped(docs.select(F.col(text_col).cast("string").alias("_text"), *keep), _predict(model), kinds)
