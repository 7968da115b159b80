"""Pair sums by blocks of students: the same as by group and by brute force, and no shuffle of pairs."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from probity.operators import blocks, collusion
from probity.session import work_dir
from probity.streaming import windows as W

SCHEMA = "attempt_id string, student_id string, exam_id string, question_id string, answer_hash string, submission_timestamp timestamp_ntz"
AS_OF = dt.datetime(2024, 1, 10, 12)


def attempts(spark, seed, n=300, students=13, nulls=True):
    rng = random.Random(seed)
    rows = [(f"a{i}", f"S{rng.randrange(students)}", f"E{rng.randrange(2)}", f"Q{rng.randrange(5)}", f"h{min(rng.randrange(4), rng.randrange(4))}",
             None if nulls and rng.random() < 0.05 else AS_OF - dt.timedelta(minutes=rng.choice([1, 60, 119, 121, 900]), seconds=rng.randrange(50)))
            for i in range(n)]
    rows += rows[:20]                                                          # repeated keys
    if nulls:
        rows += [(None, None, "E0", "Q1", "h0", AS_OF), ("x", "S1", None, "Q1", "h0", AS_OF), ("y", "S1", "E0", "Q1", None, AS_OF)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def brute(rows, once):
    found = defaultdict(list)
    recent = lambda r: r[5] is not None and r[5] >= AS_OF - dt.timedelta(hours=2)
    for x in rows:
        for y in rows:
            if None in x[1:5] + y[1:5] or x[2:5] != y[2:5] or x[1] == y[1] or not recent(x):
                continue
            if once and not ((y[5] is not None and not recent(y)) or x[1] < y[1]):
                continue
            gap = abs(x[5] - y[5]) // dt.timedelta(microseconds=1) if y[5] is not None else None
            found[x[2], min(x[1], y[1]), max(x[1], y[1])].append((gap, x[3]))
    return {k: (len(v), sum(g for g, _ in v if g is not None), sorted({q for _, q in v})) for k, v in found.items()}


@pytest.mark.parametrize("chunk", [1 << 20, 7])
def test_any_blocks_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(blocks, "CHUNK", chunk)                                 # 7: a student's rows come in several chunks
    rows, df = attempts(spark, 3)
    m = collusion._matches(df, AS_OF, "2 hours")
    groups = m.groups.select("g", "exam_id", F.col("_nr").alias("k"), (F.col("_nl") * F.col("_nr")).alias("matches"))
    for once in (False, True):
        every = brute(rows, once)
        for least in (1, 4):
            want = {k: v for k, v in every.items() if v[0] >= least}
            for n in (0, 1, 4):
                got = blocks.pair_sums(m.rows, groups, ["exam_id"], questions=True, least=least, once=once, blocks=n).collect()
                assert {(r.exam_id, r.s1, r.s2): (r.n, r.us or 0, list(r.questions)) for r in got} == want and len(got) == len(want)


def test_members_by_blocks_and_by_group(spark, monkeypatch):
    _, df = attempts(spark, 4)
    queries = {"j1": collusion.hash_match_pairs, "a5": collusion.kpi_answer_similarity, "q7": collusion.answer_jaccard,
               "a21": collusion.pair_suspicion, "classes": lambda a: collusion.answer_class_pairs(a)[1]}
    found = {}
    for n in (0, 1, 3):
        real = blocks.pair_sums
        monkeypatch.setattr(collusion, "pair_sums", lambda *a, n=n, **k: real(*a, **k | {"blocks": n}))
        found[n] = {k: sorted(map(str, q(df).collect())) for k, q in queries.items()}
    assert found[0] == found[1] == found[3] and all(found[0].values())


def test_pairs_are_not_shuffled(spark):
    """What follows the exchange of the rows has no other exchange; before, every pair went through one."""
    _, df = attempts(spark, 5, n=2000, students=20, nulls=False)
    for q in (collusion.hash_match_pairs, collusion.kpi_answer_similarity, collusion.answer_jaccard, collusion.pair_suspicion,
              lambda a: collusion.collusion_pairs(a, F.lit(AS_OF), "2 hours")):
        plan = q(df)._jdf.queryExecution().sparkPlan().toString()
        found = q(df)._jdf.queryExecution().executedPlan().toString()
        assert "FlatMapGroupsInArrow" in plan and "SortMergeJoin" not in found
        assert found.count("Exchange hashpartitioning") == 1


def test_first_batch_keeps_its_own_horizon_only(spark):
    rows = [(f"a{i}", f"S{i % 9}", "E", "Q", "h", AS_OF - dt.timedelta(hours=i)) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    state = W.CollusionState(spark, work_dir(spark, "own"), "2 hours", "10 minutes")
    state.add(df, 0)
    at = int((AS_OF - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))
    assert state.sums.total().agg(F.min("pane")).first()[0] >= state.horizon.cut(at)
    want = collusion.collusion_pairs(df, F.lit(AS_OF), "2 hours").select("student_1_id", "student_2_id", "matching_questions_count", "questions")
    got = state.current(at).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 3
