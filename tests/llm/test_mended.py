"""Cases that once went wrong: rows that share an id or have none in passage
dedup, ties in mixing, and groups of near copies in the n-gram join."""

import gzip
import random
import re
from datetime import UTC, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmart.llm import langid, mixing, ngram_join, suffix_dedup, warc
from tripmart.session import shared_path

TEXTS = "doc_id long, text string"


def words(tag, n):
    return " ".join(f"{tag}{i}" for i in range(n))


@pytest.mark.parametrize("turn", [1, -1])
def test_texts_of_one_id_with_like_hashes_are_two_documents(spark, turn):
    """Two texts under one id whose hashes agree in their first 23 bits."""
    some = spark.range(12_000).select("id", F.shiftrightunsigned(F.xxhash64(F.concat(
        F.lit(words("x", 30) + " n"), F.col("id"))), 41).alias("h"))
    pair = some.groupBy("h").agg(F.collect_list("id").alias("ids")).where("size(ids) > 1").first()["ids"]
    short, other = (words("x", 30) + f" n{i}" for i in pair[:2])
    passage = words("p", 70)
    rows = [(1, passage), (7, short), (7, other + " " + passage), (7, other + " " + passage)][::turn]
    got = sorted((r.doc_id, r.cut_words, len(r.text.split())) for r in
                 suffix_dedup.cut_repeats(spark.createDataFrame(rows, TEXTS)).collect())
    assert got == [(1, 0, 70), (7, 0, 31), (7, 70, 31), (7, 70, 31)]


def test_rows_without_an_id_lose_later_passages(spark):
    passage = words("p", 70)
    rows = [(None, words("a", 20) + " " + passage), (None, passage + " " + words("b", 30)), (None, "short"), (None, None)]
    cut = sorted(r.cut_words for r in suffix_dedup.cut_repeats(spark.createDataFrame(rows, TEXTS)).collect())
    assert cut == [0, 0, 0, 70]
    rows.append((3, "before " + passage))
    got = {r.doc_id: r.cut_words for r in suffix_dedup.cut_repeats(spark.createDataFrame(rows, TEXTS)).collect()}
    assert got[3] == 0 and suffix_dedup.cut_repeats(spark.createDataFrame(rows, TEXTS)).where(
        "doc_id is null and cut_words = 70").count() == 2


@pytest.mark.parametrize("equal", [True, False])
def test_ties_take_as_many_copies_as_fit(spark, equal):
    rows = [(None, words("w" if equal else f"w{i}x", 10), "a") for i in range(400)] + [(i, words("v", 3), "b") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    out = mixing.mix(df).groupBy("source").agg(F.first("target").alias("t"), F.sum(F.expr("copies * size")).alias("n"),
                                               F.count("*").alias("rows"), F.max("copies").alias("most")).collect()
    assert {r.source: r.rows for r in out} == {"a": 400, "b": 900}
    for r in out:
        assert abs(r.n - r.t) <= {"a": 5, "b": 1.5}[r.source] and r.most <= 3


def near_copies(r, n, changes):
    base = [f"b{i}" for i in range(300)]
    out = [" ".join(base)]
    for _ in range(n - 1):
        w = list(base)
        for _ in range(changes):
            w[r.randrange(len(w))] = f"new{r.random()}"
        out.append(" ".join(w))
    return out


def sets(text):
    w = text.split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def test_pairs_grow_with_a_group_not_with_its_square(spark, monkeypatch):
    """Rows that the join writes per member of a group of near copies, some of
    which are too far apart to link."""
    saved, sizes = ngram_join.saved, {}

    def counted(df, name):
        out = saved(df, name)
        if name in ("pairs", "across"):
            sizes[name] = sizes.get(name, 0) + out.count()
        return out
    monkeypatch.setattr(ngram_join, "saved", counted)
    most = {}
    for n in (100, 400):
        sizes.clear()
        r = random.Random(n)
        texts = near_copies(r, n // 2, 4) + near_copies(r, n // 2, 13)[1:]
        rows = list(enumerate(texts))
        got = {x.doc_id: x.component_id for x in ngram_join.ngram_join(
            spark.createDataFrame(rows, TEXTS).repartition(4)).collect()}
        most[n] = sum(sizes.values()) / n
        if n == 100:
            s, root = [sets(t) for t in texts], list(range(len(texts)))
            for a in range(len(s)):
                for b in range(a):
                    if 5 * len(s[a] & s[b]) >= 4 * len(s[a] | s[b]):
                        x, y = root[a], root[b]
                        root = [min(x, y) if k in (x, y) else k for k in root]
            assert got == dict(enumerate(root)) and len(set(root)) > 1
    assert most[400] <= 2 * most[100]


def test_a_chain_of_links_is_one_component(spark):
    """Each text is similar enough to the next one only."""
    texts, w = [], [f"c{i}" for i in range(200)]
    for i in range(40):
        texts.append(" ".join(w))
        for k in range(4):
            w[(i * 4 + k) % 200] = f"d{i}x{k}"
    s = [sets(t) for t in texts]
    assert all(5 * len(a & b) >= 4 * len(a | b) for a, b in zip(s, s[1:]))
    assert 5 * len(s[0] & s[9]) < 4 * len(s[0] | s[9])
    got = ngram_join.ngram_join(spark.createDataFrame(list(enumerate(texts)), TEXTS).repartition(3)).collect()
    assert {x.component_id for x in got} == {0}


def test_fine_points_bound_the_overlap():
    r = random.Random(2)
    for _ in range(300):
        both, a, b = (r.sample(range(1 << 62), r.randint(0, r.choice([3, 60, 900]))) for _ in range(3))
        x, y = (np.sort(np.array(sorted(set(both) | set(c)), np.uint64) * np.uint64(4)) for c in (a, b))
        if not len(x) or not len(y):
            assert ngram_join._fine(x if not len(x) else y) == b""
            continue
        p, q = (ngram_join._groups(ngram_join._fine(s)) for s in (x, y))
        assert len(p[1]) == len(x) and (p[1] == (x >> np.uint64(64 - p[0])).astype(np.int64)).all()
        assert len(np.intersect1d(x, y)) <= ngram_join._shared_groups(p, q) <= len(x)
    assert ngram_join._fine(np.arange(5000, dtype=np.uint64)) == b""


def test_sample_is_the_least_of_each_label_in_any_grouping(spark, monkeypatch):
    monkeypatch.setattr(langid, "DOCS_PER_LABEL", 9)
    monkeypatch.setattr(langid, "FAN_IN", 2)
    one = ["lang", "id", "h"]
    rows = [("hot" if i % 10 else f"l{i % 3}", i, i * 7919 % 101) for i in range(1500)]
    df = spark.createDataFrame(rows, "lang string, id long, h long")
    want = {}
    for lang, i, h in rows:
        want.setdefault(lang, []).append((h, i))
    want = {lang: sorted(v)[:9] for lang, v in want.items()}
    for parts in (1, 7):
        got = {}
        for r in langid._least(df.repartition(parts).distinct(), one, [F.col("h"), F.col("id")]).collect():
            got.setdefault(r.lang, []).append((r.h, r.id))
        assert {lang: sorted(v) for lang, v in got.items()} == want
    assert langid._least(df.limit(0), one, [F.col("h"), F.col("id")]).count() == 0


def test_warc_records_have_dates_and_names_of_their_own(spark):
    same = "x" * 120
    rows = [(1, same, "2024-02-03 04:05:06"), (2, same, None), (2, same, "no time"), (3, "short", None),
            (3, "short", None), (None, same, None), (None, same, None), (4, "y" * 200, "0001-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "page_id long, html string, seen string").withColumn("url", F.lit("u"))
    folder = shared_path(spark, "test", "warc")
    manifest = warc.write_warc(df, folder, date_col="seen")
    raw = [gzip.decompress(r.content) for r in spark.read.format("binaryFile").load(folder).collect()]
    heads = re.findall(rb"WARC/1.1\r\n(.*?)\r\n\r\n", b"".join(raw), re.S)
    heads = [dict(line.split(": ", 1) for line in h.decode().split("\r\n")) for h in heads]
    assert len(heads) == len(rows) == len({h["WARC-Record-ID"] for h in heads})
    assert all(re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", h["WARC-Date"]) for h in heads)
    names = {h["WARC-Record-ID"]: h["WARC-Type"] for h in heads}
    refers = [h["WARC-Refers-To"] for h in heads if "WARC-Refers-To" in h]
    assert len(refers) == 2 and {names[r] for r in refers} == {"response"}
    got = warc.read_warc(spark, folder, manifest).collect()
    assert sorted((r.page_id, r.refers_to) for r in got if r.page_id and r.refers_to) == [(2, 1), (2, 1)]
    when = {r.page_id: r.date for r in got}
    zone = spark.conf.get("spark.sql.session.timeZone")
    want = spark.sql("SELECT date_format(to_utc_timestamp(TIMESTAMP '2024-02-03 04:05:06', "
                     f"'{zone}'), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")").first()[0]
    assert when[1] == want and when[4].startswith("000")
    now = datetime.now(UTC).year
    assert all(int(when[i][:4]) in (now - 1, now) for i in (2, 3, None))
