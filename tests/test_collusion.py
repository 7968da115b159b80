"""Pair operators on hand-made rows, the grid join's hot-key path, and the
prefix-filtered near-duplicate join against brute force."""

import itertools

from pyspark.sql import functions as F

from probity.operators import collusion, similarity
from probity.operators.pairs import grid_join


def test_pair_with_three_equal_answers(spark):
    # ann and bob agree on all three questions, cyd agrees with nobody
    rows = [("ann", "geo-4", "h1"), ("bob", "geo-4", "h1"), ("cyd", "geo-4", "h3"),
            ("ann", "geo-5", "h1"), ("bob", "geo-5", "h1"),
            ("ann", "geo-9", "h1"), ("bob", "geo-9", "h1")]
    df = spark.createDataFrame(rows, "student_id string, question_id string, answer_hash string")
    out = collusion.pair_suspicion(df, threshold=3).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.student_1, r.student_2, r.matching_questions) == ("ann", "bob", 3)
    assert r.suspicion_score == 1.0 and r.risk_level == "High"
    assert list(r.questions) == ["geo-4", "geo-5", "geo-9"]


def test_no_self_pairs_and_multiplicity(spark):
    rows = [("a1", "S1", "E", "Q", "h"), ("a2", "S1", "E", "Q", "h"), ("a3", "S2", "E", "Q", "h")]
    df = spark.createDataFrame(rows, "attempt_id string, student_id string, exam_id string, "
                                     "question_id string, answer_hash string")
    out = collusion.kpi_answer_similarity(df).collect()
    # S1 answered twice: two attempt pairs with S2, one distinct question, no S1-S1 pair
    assert [(r.student_1, r.student_2, r.matching_questions) for r in out] == [("S1", "S2", 2)]
    j = collusion.hash_match_pairs(df).collect()
    assert [(r.student_1, r.student_2, r.question_id, r.attempt_pairs) for r in j] == [("S1", "S2", "Q", 2)]


def test_grid_join_hot_keys_equal_plain_join(spark):
    rows = [("k1", i) for i in range(40)] + [("k2", i) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, v int")
    left = df.select("k", F.col("v").alias("a"))
    right = df.select("k", F.col("v").alias("b"))
    got = grid_join(left, right, ["k"], F.col("a"), F.col("b"),
                    condition=F.col("a") < F.col("b"), cell_rows=4)   # k1 split into a 10x10 grid
    got = sorted((r.k, r.a, r.b) for r in got.collect())
    want = sorted((k, a, b) for (k, a), (k2, b) in itertools.product(rows, rows) if k == k2 and a < b)
    assert got == want


def test_collusion_cases_first_five_students(spark):
    import datetime as dt
    ts = dt.datetime(2024, 1, 1, 12)
    rows = [(f"S{i:02d}", "E", "Q", "h", ts) for i in range(9, 0, -1)] + [("S01", "E", "Q", "h", ts)]
    df = spark.createDataFrame(rows, "student_id string, exam_id string, question_id string, "
                                     "answer_hash string, submission_timestamp timestamp")
    r = collusion.collusion_cases(df).first()
    assert list(r.students) == ["S01", "S02", "S03", "S04", "S05"] and r["count"] == 10


def test_near_duplicates_match_brute_force(spark):
    base = [f"w{i}" for i in range(200)]
    docs = {1: base, 2: base[:150] + ["x"] * 10 + base[160:], 3: base,  # 3 copies 1
            4: base[:100], 5: [f"z{i}" for i in range(100)], 6: base[:190] + ["y"] * 10}
    data = [(k, " ".join(v)) for k, v in docs.items()]
    df = spark.createDataFrame(data, "doc_id long, text string")
    sets = {r.id: set(r.toks) for r in similarity.token_sets(df).collect()}
    reps = {}
    for k in sorted(sets):
        reps.setdefault(frozenset(sets[k]), k)
    for t in (0.5, 0.8, 0.9):
        want = set()
        for a, b in itertools.combinations(sorted(reps.values()), 2):
            j = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
            if j >= t:
                want.add((a, b))
        got = {(r.doc_a, r.doc_b) for r in similarity.near_duplicates(df, min_jaccard=t, cell_rows=2).collect()}
        assert got == want, t
    classes = {r.id: r.representative for r in similarity.copy_classes(similarity.token_sets(df)).collect()}
    assert classes[3] == 1 and classes[1] == 1


def test_windowed_pairs_count_both_sides_when_both_recent(spark):
    import datetime as dt
    as_of = dt.datetime(2024, 1, 10, 12)
    recent, old = as_of - dt.timedelta(minutes=5), as_of - dt.timedelta(days=3)
    rows = []
    for q in ("Q1", "Q2", "Q3"):
        rows += [(f"a{q}", "S1", "E", q, "h", recent), (f"b{q}", "S2", "E", q, "h", recent),
                 (f"c{q}", "S3", "E", q, "h", old)]
    df = spark.createDataFrame(rows, "attempt_id string, student_id string, exam_id string, "
                                     "question_id string, answer_hash string, submission_timestamp timestamp_ntz")
    two = {(r.student_1_id, r.student_2_id): r.matching_questions_count
           for r in collusion.collusion_pairs(df, as_of, "2 hours").collect()}
    one = {(r.student_1_id, r.student_2_id): r.matching_questions_count
           for r in collusion.collusion_pairs(df, as_of, "2 hours", once=True).collect()}
    # S1-S2 both recent: seen from both sides (quirk Q6); pairs with the old S3 once
    assert two == {("S1", "S2"): 6, ("S1", "S3"): 3, ("S2", "S3"): 3}
    assert one == {("S1", "S2"): 3, ("S1", "S3"): 3, ("S2", "S3"): 3}


def test_grid_split_on_fixture_equals_unsplit(spark):
    from conftest import SF_CHECK
    from probity.sources.tables import Tables
    t = Tables(spark, SF_CHECK)
    base = collusion.kpi_answer_similarity(t.attempts)
    split = collusion.kpi_answer_similarity(t.attempts, cell_rows=7)   # ~20-row groups -> 3x3 grids
    assert base.exceptAll(split).count() == 0 and split.exceptAll(base).count() == 0
    assert split.count() == 44278


def _pairs_fixture(spark, n_questions):
    import datetime as dt
    as_of = dt.datetime(2024, 1, 10, 12)
    ts = as_of - dt.timedelta(minutes=5)
    rows = []
    for q in range(n_questions):
        qid = f"Q{q:03d}"
        rows += [(f"a{q}", "S1", "E", qid, "h", ts), (f"b{q}", "S2", "E", qid, "h", ts)]
    df = spark.createDataFrame(rows, "attempt_id string, student_id string, exam_id string, "
                                     "question_id string, answer_hash string, submission_timestamp timestamp_ntz")
    return df, as_of


def test_collusion_question_sets_bitmask_and_fallback(spark):
    for n in (5, 70):      # <= 64 questions: bit_or encoding; 70: exact collect_set fallback
        df, as_of = _pairs_fixture(spark, n)
        r = collusion.collusion_pairs(df, as_of, "2 hours", once=True).first()
        assert r.matching_questions_count == n
        assert list(r.questions) == [f"Q{q:03d}" for q in range(n)]


def _random_attempts(spark, seed, students=14, questions=9, n=260):
    import datetime as dt
    import random
    rng = random.Random(seed)
    as_of = dt.datetime(2024, 1, 10, 12)
    rows = []
    for i in range(n):
        q = rng.randrange(questions)
        age = rng.choice([1, 30, 90, 119, 121, 600, 5000])
        rows.append((f"a{i}", f"S{rng.randrange(students):02d}", f"E{rng.randrange(2)}", f"Q{q}", f"h{min(rng.randrange(4), rng.randrange(4))}",
                     as_of - dt.timedelta(minutes=age, seconds=rng.randrange(50))))
    rows += [(None, None, "E0", "Q1", "h0", as_of), ("x", "S01", None, "Q1", "h0", as_of), ("y", "S01", "E0", "Q1", None, as_of)]
    return rows, spark.createDataFrame(rows, "attempt_id string, student_id string, exam_id string, question_id string, "
                                             "answer_hash string, submission_timestamp timestamp_ntz"), as_of


def _slow_pairs(rows, as_of, once, least):
    import datetime as dt
    from collections import defaultdict
    found = defaultdict(list)
    for x in rows:
        for y in rows:
            if x is y or None in x[1:5] + y[1:5] or x[2:5] != y[2:5] or x[1] == y[1]:
                continue
            recent = lambda r: r[5] >= as_of - dt.timedelta(hours=2)
            if recent(x) and (not once or not recent(y) or x[1] < y[1]):
                found[min(x[1], y[1]), max(x[1], y[1]), x[2]].append((abs(x[5] - y[5]).total_seconds(), x[3]))
    return {k: (len(v), round(sum(t for t, _ in v) / len(v), 6), sorted({q for _, q in v})) for k, v in found.items() if len(v) >= least}


def test_prefix_filter_equals_all_pairs_and_brute_force(spark):
    for seed in (1, 2):
        rows, df, as_of = _random_attempts(spark, seed)
        m = collusion._matches(df, as_of, "2 hours")
        counts = {k: collusion.match_counts(m, k) for k in (3, 5, 10)}
        print(counts)
        assert counts[3]["prefix"] >= counts[5]["prefix"] >= counts[10]["prefix"]
        assert counts[10]["prefix"] < 0.6 * counts[10]["every"]
        for least in (3, 5, 10):
            for once in (False, True):
                want = _slow_pairs(rows, as_of, once, least)
                for prefix in (False, True):
                    got = collusion.collusion_pairs(df, as_of, "2 hours", least, once, cell_rows=5, prefix=prefix).collect()
                    assert {(r.student_1_id, r.student_2_id, r.exam_id): (
                        r.matching_questions_count, round(r.avg_time_difference_seconds, 6), list(r.questions)) for r in got} == want
                    assert len(got) == len(want)


def test_many_questions_as_sets_and_as_bits(spark, monkeypatch):
    rows, df, as_of = _random_attempts(spark, 5)
    want = _slow_pairs(rows, as_of, False, 3)
    for bits, masks in ((2, 8), (1, 2)):                # five masks of two bits; too many questions for masks
        monkeypatch.setattr(collusion, "BITS", bits)
        monkeypatch.setattr(collusion, "MASKS", masks)
        for prefix in (False, True):
            got = collusion.collusion_pairs(df, as_of, "2 hours", prefix=prefix).collect()
            assert {(r.student_1_id, r.student_2_id, r.exam_id): list(r.questions) for r in got} == {k: v[2] for k, v in want.items()}


def test_no_attempts_give_no_pairs(spark):
    _, df, as_of = _random_attempts(spark, 1)
    for prefix in (False, True, None):
        assert collusion.collusion_pairs(df.limit(0), as_of, "2 hours", 10, prefix=prefix).count() == 0


def test_class_pairs_expand_to_the_student_pairs(spark):
    rows, df, _ = _random_attempts(spark, 3, students=5)
    copies = df.filter("student_id is not null").withColumn("student_id", F.concat("student_id", F.lit("x")))
    every = df.union(copies).union(copies.withColumn("student_id", F.concat("student_id", F.lit("y"))))
    members, pairs = collusion.answer_class_pairs(every)
    got = collusion.expand_class_pairs(members, pairs)
    want = collusion.kpi_answer_similarity(every)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert pairs.agg(F.sum("links")).first()[0] == want.count()
    assert pairs.count() < want.count() / 4             # classes of three
    assert {r.class_size for r in members.collect()} == {3}


def test_class_output_does_not_grow_with_copied_sheets(spark):
    """Ten times the students on the same sheets: ten times the membership, the same class pairs."""
    sizes = []
    for n in (20, 200):
        df = spark.range(n * 4).selectExpr("concat('a', id) attempt_id", f"concat('S', lpad(id % {n}, 4, '0')) student_id", "'E' exam_id",
                                           f"concat('Q', id div {n}) question_id", f"concat('h', (id % {n}) % 5) answer_hash")
        members, pairs = collusion.answer_class_pairs(df)
        sizes.append((members.count(), pairs.count(), collusion.kpi_answer_similarity(df).count()))
    assert sizes[1][0] == 10 * sizes[0][0] and sizes[1][1] == sizes[0][1] and sizes[1][2] > 100 * sizes[0][2]
