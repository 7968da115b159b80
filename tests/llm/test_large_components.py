"""Exact top-k with large finite components, letters of every plane, and scratch space of the pipeline."""

import math
import os
import random

from pyspark.sql import functions as F

from conftest import SF_SMALL
from probity.llm import balltree, langid, queries
from probity.session import work_scope


def test_top_k_with_large_components(spark, monkeypatch):
    monkeypatch.setattr(balltree, "QUERIES", 7)
    rng = random.Random(2)
    value = lambda: rng.choice([rng.uniform(-1, 1), rng.uniform(-1, 1), rng.uniform(-1, 1), -0.0, 3.0])
    rows = [(i, [value() for _ in range(6)]) for i in range(60)]
    for i, big in ((3, 3e5), (10, 1e30), (20, -1e30), (25, 5e15), (30, 1.7e38), (41, -2e9)):
        rows[i][1][i % 6] = big
    rows += [rows[10], (900, [float("inf")] + [0.0] * 5), (901, [1e30, None, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    held = [(r.vec_id, [math.floor(256 * int(x)) if abs(x) > 2 ** 50 else math.floor(256 * x) for x in r.embedding])
            for r in df.filter("vec_id < 900").collect()]
    v = balltree.quantised(df)
    got = balltree.top_k(v, v.filter("vec_id % 10 = 0"), 5).orderBy("query_id", "rank").collect()
    want = []
    for q in sorted({i for i, _ in held if i % 10 == 0}):
        for a in (x for i, x in held if i == q):
            scores = sorted(((-sum(p * r for p, r in zip(a, b)), j) for j, b in held if j != q))
            want.append((q, [(j, max(-2 ** 63, min(2 ** 63 - 1, -s))) for s, j in scores[:5]]))
    want = {q: w for q, w in want}                          # the repeated row is the same query
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    once = lambda xs: list(dict.fromkeys(xs))
    assert by.keys() == want.keys()
    for q in want:
        assert once(by[q])[:3] == once(want[q])[:3]


def test_letters_of_the_third_plane(spark):
    table = langid.fold_table()
    assert table[0x30001] == 0x30001 and table[0x323AF] and not table[0x1F600] and table[ord("A")] == ord("a")
    docs = spark.createDataFrame([(1, chr(0x30001) * 9, "zz"), (2, "plain words here", "en")], "doc_id long, text string, lang string")
    model = langid.learn(docs)
    found = langid.identify(docs.withColumn("held_out", F.lit(False)), model)
    assert {r.doc_id: r.lang_pred for r in found.collect()} == {1: "zz", 2: "en"}


def test_pipeline_leaves_no_more_than_its_last_input(spark):
    with work_scope(spark) as made:
        rows = queries.pipeline(spark, SF_SMALL).count()
        left = [p for p in made if os.path.isdir(p)]
        assert rows > 0 and len(left) == 1 and len(os.listdir(left[0])) == 1
    assert not os.path.exists(left[0])
