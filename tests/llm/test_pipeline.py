"""The corpus pipeline against plain versions of its stages."""

import corpus_pipeline as cp
import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF001
from tests.llm.test_operators import DOCS, components, plain_quality, plain_repeats, words


def test_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    steps = [docs]
    for _, stage in cp.STAGES:
        steps.append(stage(spark, steps[-1], SF001).cache())
    for s in steps[1:-1]:
        assert s.columns == docs.columns
    first = {r.doc_id for r in steps[1].collect()}
    assert first == {i for i, r in rows.items() if plain_quality(r.text)[-1]}
    near = components([(i, rows[i].text) for i in first], 5, 4, 5)
    second = {r.doc_id for r in steps[2].collect()}
    assert second == {i for i in first if near[i][1] == i}
    gone = plain_repeats([(i, rows[i].text) for i in second], 50)
    third = {r.doc_id: r for r in steps[3].collect()}
    for i in second:
        left = [w for p, w in enumerate(words(rows[i].text)) if p not in gone.get(i, (set(),))[0]]
        assert (words(third[i].text) == left) if left else i not in third
    mixed = steps[4].groupBy("doc_id").count().collect()
    assert {r.doc_id for r in mixed} <= set(third) and all(1 <= r["count"] <= 3 for r in mixed)
    pieces = steps[5]
    sizes = steps[5].groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert max(r.n for r in sizes) <= 1024
    tokens = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
    copies = {r.doc_id: r["count"] for r in mixed}
    assert {r.doc_id: r.n for r in tokens} == {r.doc_id: r.t * copies[r.doc_id] for r in tokens}
    assert np.all([r.doc_id in copies for r in tokens])


def test_run_writes_each_stage(spark):
    out = cp.run(spark, SF001)
    assert out.count() > 0 and "sequence_id" in out.columns and cp.ORACLE_SQL is None


def kept_once(rows):
    """``near_duplicates`` by all pairs: of each group the least (id, text), null ids last."""
    of = sorted({(i is None, i or 0, t is not None, t or "") for i, t in rows})
    group = components([(n, d[3]) for n, d in enumerate(of)], 5, 4, 5)
    return [(None if d[0] else d[1], d[3] if d[2] else None) for n, d in enumerate(of) if group[n][1] == n]


def test_near_duplicates_decide_by_row(spark):
    text = lambda tag, n=40: " ".join(f"{tag}{j}" for j in range(n))
    near = lambda tag: text(tag) + " changed"
    rows = [(1, text("a")), (1, text("a")), (1, text("a")),          # repeated rows
            (2, near("a")), (2, text("b")),                          # one id, only one text is a copy
            (3, text("c")), (5, text("d")), (5, near("c")),          # the same, the smaller id alone
            (7, text("e")), (7, near("e")), (7, text("f")),          # near copies under one id
            (9, near("f")), (8, text("f") + " x"),
            (None, text("g")), (None, text("g")), (None, text("h")), # null ids, copies among them
            (20, near("h")), (-4, text("i")), (None, text("i")),
            (30, ""), (30, ""), (31, ""), (32, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS).repartition(4)
    got = cp.near_duplicates(spark, docs, SF001)
    assert got.columns == docs.columns
    want = kept_once(rows)
    key = lambda x: (x[0] is None, x[0] or 0, x[1] is not None, x[1] or "")
    one_text = lambda x: (x[0], x[1] if x[0] not in (7, None) else (x[1] or "").split(" ")[0])
    assert sorted(map(one_text, ((r.doc_id, r.text) for r in got.collect())), key=key) == \
        sorted(map(one_text, want), key=key)
    assert sorted(r.doc_id for r in got.collect() if r.doc_id is not None) == \
        [-4, 1, 2, 3, 5, 7, 7, 20, 30, 31, 32]


def test_copies_that_differ_in_other_columns_stay_once(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, lang, source, 9) for lang in ("a", None) for source in ("x", "y")] * 3
    rows += [(None, text + " z", "a", "x", 9)] * 5
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = [tuple(r) for r in cp.near_duplicates(spark, docs, SF001).collect()]
    assert got == [(1, text, None, "x", 9)]
    assert cp.near_duplicates(spark, docs.limit(0), SF001).count() == 0
