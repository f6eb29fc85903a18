"""Operators 11 to 13 against plain versions, and their edge cases: nulls, empty
and very long texts, ties, repeated rows, empty tables and extra columns with
clashing names."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tripmart.llm import pq_dedup, prefix_trie, queries, runs
from tripmart.llm.common import mix

# 11. Product-quantised lists


def plain_links(rows, least):
    """{row number: (links, component)} of ``(id, label, vector)`` rows."""
    def ok(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    use = [i for i, (a, b, v) in enumerate(rows) if a is not None and b is not None and ok(v)]
    dims = max([len(rows[i][2]) for i in use], default=1)
    unit = {i: np.pad(np.array(rows[i][2], float), (0, dims - len(rows[i][2]))) for i in use}
    unit = {i: v / np.abs(v).max() for i, v in unit.items()}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    root = {a: a for a, _, _ in rows if a is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    n = [0] * len(rows)
    for i in use:
        for j in use:
            if i < j and rows[i][1] == rows[j][1] and unit[i] @ unit[j] >= least:
                n[i], n[j] = n[i] + 1, n[j] + 1
                a, b = find(rows[i][0]), find(rows[j][0])
                root[max(a, b)] = min(a, b)
    return sorted((str(a), n[i], str(None if a is None else find(a)), a is not None and find(a) == a)
                  for i, (a, _, _) in enumerate(rows))


VECTORS = "vec_id long, label int, embedding array<double>, n_links string, home int"


def found(df):
    return sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in pq_dedup.near_vectors(df).collect())


def vectors(seed, n=160, dims=12):
    r = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        v = r.normal(size=dims)
        label = None if len(rows) % 23 == 0 else int(r.integers(0, 3))
        for _ in range(int(r.choice([1, 1, 1, 2, 12]))):
            noise = r.normal(size=dims) * np.linalg.norm(v) * r.choice([0, 0.04, 0.1]) / np.sqrt(dims)
            rows.append((len(rows), label, [float(x) for x in v + noise]))
    odd = [(900, 1, None), (901, 1, []), (902, 1, [0.0] * dims), (903, 1, [1.0, None] + [0.0] * (dims - 2)),
           (904, 1, [float("nan")] + [1.0] * (dims - 1)), (905, 1, [float("inf")] + [1.0] * (dims - 1)),
           (906, 1, [1.0]), (907, 1, [5.0, 0.0]), (None, 1, [1.0]), (908, 1, [1e-200, 0.0]), (909, 1, [1e200]),
           rows[5], rows[6], rows[6]]
    return rows + odd


@pytest.mark.parametrize("seed,block,lists", [(1, 4096, 1024), (2, 4096, 8), (3, 7, 8), (4, 3, 60)])
def test_near_vectors_equal_brute_force(spark, monkeypatch, seed, block, lists):
    """Also with lists cut into blocks, and with many lists."""
    monkeypatch.setattr(pq_dedup, "BLOCK_ROWS", block)
    monkeypatch.setattr(pq_dedup, "LIST_ROWS", lists)
    monkeypatch.setattr(pq_dedup, "SIGMAS", 6)  # few dimensions: the rule of large ones is loose there
    rows = vectors(seed)
    df = spark.createDataFrame([(*x, "clash", 1) for x in rows], VECTORS).repartition(3)
    want = plain_links(rows, 0.93)
    assert found(df) == want and sum(x[1] for x in want) > 100


def test_near_vectors_recall_on_many_lists(spark, monkeypatch):
    """Recall with the production probes where every list holds a few vectors."""
    monkeypatch.setattr(pq_dedup, "LIST_ROWS", 20)
    r = np.random.default_rng(8)
    base = r.normal(size=(1500, 64))
    near = base[:600] + r.normal(size=(600, 64)) * 0.3       # cosine about 0.957
    rows = [(i, 0, [float(x) for x in v]) for i, v in enumerate(np.concatenate([base, near]))]
    df = spark.createDataFrame([(*x, "", 0) for x in rows], VECTORS)
    got = {int(a): n for a, n, _, _ in found(df)}
    want = {int(a): n for a, n, _, _ in plain_links(rows, 0.93)}
    total = sum(want.values())
    assert total > 1000 and all(got[k] <= want[k] for k in want) and sum(got.values()) >= 0.99 * total


def test_near_vectors_of_nothing(spark):
    df = spark.createDataFrame([(*x, "", 0) for x in vectors(1)[-14:-11]], VECTORS)
    assert found(df) == [("900", 0, "900", True), ("901", 0, "901", True), ("902", 0, "902", True)]
    assert pq_dedup.near_vectors(df.limit(0)).count() == 0


# 12. Prefix trie

def plain_trie(rows, rebuild=True):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            turn = hashlib.sha256(f"{len((r or '').encode())}:{r or ''}{x or ''}".encode()).hexdigest()[:32]
            convs.setdefault(c, []).append((t is not None, t or 0, turn, r or "", x or ""))
    for c in convs:
        convs[c] = [t[3:] for t in sorted(convs[c])]
    new = dict(convs)
    for c in convs if rebuild else ():
        h = zlib.crc32(str(c).encode()) % 9
        new[c] = convs.get(c - c % 5, [])[:h] + convs[c][h:]
    nodes, kids, memo, out = {}, {}, {}, []
    for c, s in new.items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    for k in nodes:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    for k in sorted(nodes, key=len, reverse=True):
        below = kids.get(k, [])
        own = (len(nodes[k]) - 1) * len(k[-1][1].encode()) if k else 0
        memo[k] = sum(memo[x][0] for x in below) or 1, sum(memo[x][1] for x in below) + own
        ends = ",".join(str(c) for c in sorted(nodes[k]) if len(new[c]) == len(k))
        out.append((min(nodes[k]), len(k), min(nodes[k[:-1]]) if k else None, len(nodes[k]), len(below), *memo[k],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


TURNS = "conv_id long, turn long, role string, text string, key string, node int"


def talks(seed, n):
    r, rows = random.Random(seed), []
    for c in range(n):
        many = 3 if c % 7 else r.choice([0, 1, 9, 40])
        for t in range(many):
            text = r.choice(["a", "a", "é", "", None, "long " * 30])
            rows.append((c, None if t == 0 and c % 3 == 0 else t // (1 + c % 2), r.choice(["user", "assistant", None]), text))
        if many and c % 5 == 0:
            rows.append(rows[-1])           # a repeated row is a turn of its own
    return rows + [(None, 1, "user", "a")]


@pytest.mark.parametrize("seed,n,unit", [(1, 120, 8192), (2, 150, 1), (3, 90, 5), (4, 300, 40), (5, 1, 3)])
def test_prefix_trie_equals_plain_tree(spark, monkeypatch, seed, n, unit):
    monkeypatch.setattr(prefix_trie, "UNIT_ROWS", unit)
    rows = talks(seed, n)
    df = spark.createDataFrame([(*x, "clash", 1) for x in rows], TURNS).repartition(4)
    for keys, rebuild in ((prefix_trie.regrafted_keys, True), (prefix_trie.conversation_keys, False)):
        got = sorted((tuple(x) for x in prefix_trie.prefix_trie(keys(df)).collect()), key=str)
        assert got == plain_trie(rows, rebuild)


def test_prefix_trie_of_copies_a_very_long_talk_and_nothing(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "UNIT_ROWS", 50)
    rows = [(5 * c, t, "user", f"t{t}") for c in range(400) for t in range(10)]
    rows += [(3, t, "user", f"x{t % 3}") for t in range(1500)]
    df = spark.createDataFrame([(*x, "", 0) for x in rows], TURNS).repartition(4)
    got = sorted((tuple(x) for x in prefix_trie.prefix_trie(prefix_trie.conversation_keys(df)).collect()), key=str)
    assert got == plain_trie(rows, False)
    assert prefix_trie.prefix_trie(prefix_trie.regrafted_keys(df.limit(0))).count() == 0


def test_radix_tree_layouts_grow():
    tree, seen = prefix_trie.Tree(), set()
    keys = [bytes([i]) + bytes(15) for i in range(256)]
    random.Random(1).shuffle(keys)
    for i, k in enumerate(keys):
        tree.insert(k, i, [1])
        seen.add(tree.root.layout)
    assert seen == {4, 16, 48, 256} and len(tree.root.children()) == 256
    assert [tree.root.child(k[0]).ends for k in keys] == [[i] for i in range(256)]
    assert tree.root.children()[0].path == bytes(15)  # compressed: one node for 16 bytes


# 13. Periodic runs

def plain_runs(w, least):
    out, n = {}, len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def looping(r, n, kinds):
    w = [r.randrange(kinds) for _ in range(n)]
    for _ in range(r.randint(0, 3) if n else 0):
        a = r.randrange(n)
        p, e = r.randint(1, max(1, (n - a) // 2)), r.randint(a, n)
        for i in range(a, e):
            w[i] = w[a + (i - a) % p]
    return w


def test_find_runs_equals_brute_force():
    r = random.Random(13)
    for _ in range(700):
        docs = [looping(r, r.randint(0, r.choice([5, 30, 120])), r.choice([1, 2, 3, 5, 60])) for _ in range(r.randint(1, 4))]
        least = r.choice([12, 12, 2, 3, 7, 20])
        doc = np.repeat(np.arange(len(docs)), [len(w) for w in docs])
        flat = mix(np.array([x for w in docs for x in w], np.uint64) + np.uint64(1))
        a, b, q = runs.find_runs(flat, doc, least)
        at = np.cumsum([0] + [len(w) for w in docs])
        for d, w in enumerate(docs):
            mine = doc[a] == d if len(a) else np.zeros(0, bool)
            assert sorted(zip((a - at[d])[mine].tolist(), (b - a)[mine].tolist(), q[mine].tolist())) == plain_runs(w, least)


def test_find_runs_of_fibonacci_words_and_of_one_word():
    w, v = [0], [0, 1]
    while len(v) < 600:
        w, v = v, v + w
    for words in (v, [7] * 5000):
        a, b, q = runs.find_runs(mix(np.array(words, np.uint64)), np.zeros(len(words), int))
        want = plain_runs(words, 12) if len(words) < 2000 else [(0, 5000, 1)]
        assert sorted(zip(a.tolist(), (b - a).tolist(), q.tolist())) == want


def test_wavelet_tree_successor():
    r = np.random.default_rng(3)
    values = r.permutation(300)
    tree = runs.WaveletTree(values, 300)
    lo = r.integers(0, 300, 500)
    hi = lo + r.integers(0, 300 - lo + 1)
    x = r.integers(0, 310, 500)
    got = tree.successor(lo, hi, x)
    want = [min([v for v in values[a:b] if v >= y], default=-1) for a, b, y in zip(lo, hi, x)]
    assert got.tolist() == want


def test_levels_cover_every_period_once():
    for least in (2, 5, 12, 33):
        got = {}
        for size, spans in runs.levels(least, 4000).items():
            for a, b in spans:
                for q in range(a, b + 1):
                    assert q not in got
                    got[q] = size
        for q in range(1, 2001):
            assert 2 * got[q] - 1 + q <= max(least, 2 * q) < 4 * got[q] - 1 + q


def test_periodic_runs_rows(spark):
    r = random.Random(4)
    say = lambda w: " ".join("w%d" % x for x in w)
    texts = [None, "", " \n\t ", "one", say([1, 2] * 6), say([1] * 11), say([1] * 12), "É\x0bÉ " * 9 + "\n日本",
             say(looping(r, 9000, 4000)), say(list(range(50)) * 400), say([1, 2] * 6)]
    texts += [say(looping(r, r.randint(0, 150), r.choice([2, 5, 90]))) for _ in range(60)]
    rows = [(i if i % 9 else None, t, "clash", "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, lang string").repartition(3)
    out = runs.periodic_runs(df)
    assert out.columns == ["doc_id", "lang", "n_words", "runs", "collapsed"]
    got = sorted((str(x.doc_id), x.n_words, [tuple(y) for y in x.runs], x.collapsed) for x in out.collect())
    want = []
    for i, t, _, _ in rows:
        w = [x.decode() for x in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())]
        found_ = sorted(plain_runs(w, 12), key=lambda x: (x[0], x[2])) if len(w) < 5000 else None
        want.append((str(i), len(w), found_, w))
    for (a, n, found_, text), (b, m, plain, w) in zip(got, sorted(want, key=lambda x: (x[0], x[1], x[2] or []))):
        assert (a, n) == (b, m)
        if plain is not None:
            assert found_ == plain
        gone = {i for s, k, q in found_ for i in range(s + q, s + k)}
        assert text == " ".join(x for i, x in enumerate(w) if i not in gone)
    assert runs.periodic_runs(df.limit(0)).count() == 0


def test_looped_texts_follow_the_contract(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    got = {x.doc_id: x.text for x in queries.looped(df).collect()}
    changed = 0
    for x in df.collect():
        h = zlib.crc32(str(x.doc_id).encode())
        w = (x.text or "").encode().split()
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            assert got[x.doc_id].encode().split() == [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            changed += 1
        else:
            assert got[x.doc_id] == x.text
    assert changed > 3
    none = spark.createDataFrame([(None, "a b"), (1, None)], "doc_id long, text string")
    assert queries.looped(none).where(F.col("text").isNull()).count() == 1
