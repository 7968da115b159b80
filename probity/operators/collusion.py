"""Answer-hash collusion: J1, J2, J7, A5, A19, A20, A21 and T6.

Scale notes
-----------
* Attempts are first reduced to one row per (exam, question, hash, student)
  with the attempt multiplicity ``n`` (partial aggregation map-side), so a
  student answering the same thing twice never multiplies pair rows; the
  attempt-pair count of the original definition is ``n_left * n_right``.
* Pairs are joined and added up by ``blocks.pair_sums``, dealt by pairs of
  student blocks: no task receives a whole group, and pairs are not shuffled.
* Outputs that are only "who is in the same group" (J7, T6) are returned as
  group membership -- one row per member with the group's representative
  and size -- which is linear in the input instead of listing every pair.
* Group-level top-k (A19) keeps only the k smallest members per group with a
  ``row_number() <= k`` filter, which Spark plans as a partial
  ``WindowGroupLimit`` before the shuffle; arrays are built from <= k rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from probity.functions.bands import (risk_level_collusion, risk_level_suspicion,
                                     suspicion_from_count)
from probity.functions.timecols import as_column, interval, micros_between
from probity.operators.blocks import pair_sums
from probity.operators.pairs import DEFAULT_CELL_ROWS, grid_join
from probity.session import materialize

GROUP = ["exam_id", "question_id", "answer_hash"]


def answer_members(attempts: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """One row per (group, student) with the number of attempts ``n``."""
    return attempts.groupBy(*group, "student_id").agg(F.count(F.lit(1)).alias("n"))


def _member_sums(members: DataFrame, group: list[str], unit: list[str], cell_rows: int | None, **asked) -> DataFrame:
    """Sums of n x n by pair of students of the same answer group (``blocks.pair_sums``).

    The member table feeds several branches, so it is materialized once; a group goes by a number
    from there, and groups of one student end here."""
    m = materialize(members.dropna(subset=[*group, "student_id"]), "members")          # a null never equals another
    groups = m.groupBy(*group).agg(F.count(F.lit(1)).alias("k")).filter("k > 1").withColumn("matches", F.expr("k * (k - 1) / 2"))
    groups = materialize(groups.withColumn("g", F.monotonically_increasing_id()), "groups")
    also = [c for c in ("n", "a") if c in m.columns]
    rows = m.join(groups.select("g", *group), group).select("g", *unit, "question_id", F.col("student_id").alias("s"), *also)
    return pair_sums(materialize(rows, "rows"), groups, unit, cell_rows=cell_rows, **asked)


def hash_match_pairs(attempts: DataFrame, cell_rows: int | None = None) -> DataFrame:
    """Student pairs (student_1 < student_2) with an equal answer hash on
    the same exam question; ``attempt_pairs`` counts the matching attempt
    pairs (one per row of the original row-level self-join)."""
    j = _member_sums(answer_members(attempts), GROUP, ["exam_id"], cell_rows, by_question=True)
    return j.select(F.col("s1").alias("student_1"), F.col("s2").alias("student_2"), "exam_id", "question_id",
                    F.col("n").alias("attempt_pairs"))


def kpi_answer_similarity(attempts: DataFrame, cell_rows: int | None = None) -> DataFrame:
    """A5: matching attempt pairs per (student_1, student_2, exam), added up
    where they are joined.  The distinct-question count of quirk Q5 is in ``answer_jaccard``."""
    j = _member_sums(answer_members(attempts), GROUP, ["exam_id"], cell_rows)
    return j.select(F.col("s1").alias("student_1"), F.col("s2").alias("student_2"), "exam_id", F.col("n").alias("matching_questions"))


def answer_jaccard(attempts: DataFrame, cell_rows: int | None = None) -> DataFrame:
    """Q7: per pair and exam, distinct matched questions / union of the two
    students' answered questions (the documented Jaccard form).  A student's
    number of answered questions goes with the rows, so pairs are not joined again."""
    answered = (attempts.groupBy("student_id", "exam_id")
                .agg(F.countDistinct("question_id").alias("a")))
    m = answer_members(attempts).join(answered, ["student_id", "exam_id"])
    j = _member_sums(m, GROUP, ["exam_id"], cell_rows, distinct=True)
    return j.select(F.col("s1").alias("student_1"), F.col("s2").alias("student_2"), "exam_id",
                    F.col("d").alias("matching_questions_distinct"),
                    (F.col("d") / (F.col("a1") + F.col("a2") - F.col("d"))).alias("answer_jaccard"))


def _recent_flag(ts: Column, as_of, lookback: str) -> Column:
    return ts >= as_column(as_of) - interval(lookback)


def hash_match_windowed(attempts: DataFrame, as_of, lookback: str = "2 hours",
                        once: bool = False, cell_rows: int = DEFAULT_CELL_ROWS) -> DataFrame:
    """Recent attempts (left) matched to all attempts (right) on exam,
    question and hash with a different student; the pair is then ordered.

    ``once=False`` keeps the original two-sided count (a match where both
    rows are recent is seen from both sides, quirk Q6); ``once=True`` counts
    each unordered attempt pair once.
    """
    cols = [*GROUP, "student_id", "submission_timestamp", "attempt_id"]
    a = attempts.select(*cols)
    left = (a.filter(_recent_flag(F.col("submission_timestamp"), as_of, lookback))
            .select(*GROUP, F.col("student_id").alias("s_l"),
                    F.col("submission_timestamp").alias("t_l"), F.col("attempt_id").alias("id_l")))
    # only answer groups touched by a recent attempt can match: with the
    # usual 2-hour window this keeps the right side to recently active groups
    active = left.select(*GROUP).distinct()
    right = (a.join(active, GROUP, "left_semi")
             .select(*GROUP, F.col("student_id").alias("s_r"),
                     F.col("submission_timestamp").alias("t_r"), F.col("attempt_id").alias("id_r"),
                     _recent_flag(F.col("submission_timestamp"), as_of, lookback).alias("r_recent")))
    cond = F.col("s_l") != F.col("s_r")
    if once:
        cond = cond & (~F.col("r_recent") | (F.col("s_l") < F.col("s_r")))
    j = grid_join(left, right, GROUP, F.col("id_l"), F.col("id_r"), condition=cond,
                  cell_rows=cell_rows)
    return j.select(F.least("s_l", "s_r").alias("student_1_id"),
                    F.greatest("s_l", "s_r").alias("student_2_id"),
                    "exam_id", "question_id",
                    micros_between("t_l", "t_r").alias("time_diff_us"))


@dataclass
class Matches:
    """What A20 joins, written once: ``rows`` (g, student, exam_id, t, recent), ``groups`` (g, exam_id,
    question_id, rows, recent rows) with at least one recent row, and the questions by exam."""

    rows: DataFrame
    groups: DataFrame


def _matches(attempts: DataFrame, as_of, lookback: str) -> Matches:
    a = attempts.select(*GROUP, "student_id", F.unix_micros(F.col("submission_timestamp").cast("timestamp")).alias("t"),
                        _recent_flag(F.col("submission_timestamp"), as_of, lookback).alias("recent"))
    a = materialize(a.dropna(subset=[*GROUP, "student_id"]), "attempts")          # a null never equals another
    groups = a.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("_nr"), F.count(F.when(F.col("recent"), 1)).alias("_nl"))
    groups = groups.filter("_nl > 0 and _nr > 1")
    place = F.dense_rank().over(Window.partitionBy("exam_id").orderBy("question_id")) - 1     # an exam's questions: few
    questions = a.select("exam_id", "question_id").distinct().withColumn("q", place)
    groups = materialize(groups.join(questions, ["exam_id", "question_id"]).withColumn("g", F.monotonically_increasing_id()), "groups")
    rows = a.join(groups.select("g", "q", *GROUP), GROUP).select("g", "exam_id", "question_id", "q", F.col("student_id").alias("s"), "t", "recent")
    return Matches(materialize(rows, "matches"), groups)


BITS, MASKS = 63, 8


def _sums(n_questions: int) -> list[Column]:
    """Aggregates of matches: count, total gap and the questions as bits (a set, where they are many)."""
    out = [F.count(F.lit(1)).alias("n"), F.sum("us").alias("us")]
    if n_questions > BITS * MASKS:
        return [*out, F.collect_set("q").alias("qs")]
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("q", F.lit(BITS)).cast("int"))
    return out + [F.bit_or(F.when(F.expr(f"q div {BITS} = {k}"), bit).otherwise(F.lit(0).cast("long"))).alias(f"m{k}")
                  for k in range(max(1, -(-n_questions // BITS)))]


def _added(parts: DataFrame, keys: list[str]) -> DataFrame:
    aggs = [F.array_distinct(F.flatten(F.collect_list(c))).alias(c) if c == "qs" else
            (F.bit_or(c) if c.startswith("m") else F.sum(c)).alias(c) for c in parts.columns if c not in keys]
    return parts.groupBy(*keys).agg(*aggs)


PAIR = ["exam_id", "s1", "s2"]


def _met(j: DataFrame, n_questions: int) -> DataFrame:
    """Joined rows (s_l, t_l, s_r, t_r) as sums by ordered pair of students."""
    j = j.withColumns({"s1": F.least("s_l", "s_r"), "s2": F.greatest("s_l", "s_r"), "us": F.abs(F.col("t_l") - F.col("t_r"))})
    return j.groupBy(*PAIR).agg(*_sums(n_questions))


def _condition(once: bool):
    cond = F.col("s_l") != F.col("s_r")
    return cond & (~F.col("r_recent") | (F.col("s_l") < F.col("s_r"))) if once else cond


def _sides(rows: DataFrame):
    left = rows.filter("recent").select("g", "exam_id", "q", F.col("s").alias("s_l"), F.col("t").alias("t_l"))
    right = rows.select("g", F.col("s").alias("s_r"), F.col("t").alias("t_r"), F.col("recent").alias("r_recent"))
    return left, right


def _every_pair(m: Matches, min_matches: int, once: bool, cell_rows: int | None) -> DataFrame:
    groups = m.groups.select("g", "exam_id", F.col("_nr").alias("k"), (F.col("_nl").cast("double") * F.col("_nr")).alias("matches"))
    return pair_sums(m.rows, groups, ["exam_id"], questions=True, least=min_matches, once=once, cell_rows=cell_rows)


def prefixed(m: Matches, min_matches: int) -> DataFrame:
    """Weighted prefix filter: (g, s, exam_id, late), one row per group and student.

    In a group, a student adds at most ``ub`` = own recent rows x most rows of one student
    + own rows x most recent rows of one student to a pair's count.  A student's groups are
    ordered from small to large; the ``late`` ones are the longest end of that order whose
    ubs add up to less than ``min_matches``.  If the first common group of two students is late for
    either, all their common groups are, and the pair cannot reach ``min_matches``: so two
    students that do meet in a group that is late for neither.
    """
    own = m.rows.groupBy("g", "exam_id", "s").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("recent"), 1)).alias("k"))
    most = own.groupBy("g").agg(F.max("n").alias("most_n"), F.max("k").alias("most_k"), F.sum("n").alias("size"))
    ub = F.col("k") * F.col("most_n") + F.col("n") * F.col("most_k")
    from_end = Window.partitionBy("exam_id", "s").orderBy(F.desc("size"), F.desc("g")).rowsBetween(Window.unboundedPreceding, 0)
    return own.join(most, "g").withColumn("late", F.sum(ub).over(from_end) < min_matches).select("g", "exam_id", "s", "late")


def _prefix_pairs(m: Matches, marked: DataFrame, once: bool, cell_rows: int, n_questions: int) -> DataFrame:
    """Sums of the pairs that meet in a group late for neither; their late groups are looked up."""
    rows = materialize(m.rows.join(marked, ["g", "exam_id", "s"]), "marked")
    left, right = _sides(rows.filter("not late"))
    met = materialize(_met(grid_join(left, right, ["g"], F.struct("s_l", "t_l"), F.struct("s_r", "t_r"),
                                     condition=_condition(once), cell_rows=cell_rows), n_questions), "candidates")
    # every other group of a candidate is late for one of the two: take it from the student it is late for
    late = rows.filter("late")
    named = lambda df, k: df.select("g", "exam_id", "q", F.col("s").alias(f"s{k}"), F.col("t").alias(f"t{k}"),
                                    F.col("recent").alias(f"r{k}"), F.col("late").alias(f"late{k}"))
    pairs = met.select(*PAIR)
    first = pairs.join(named(late, 1), ["exam_id", "s1"]).join(named(rows, 2).drop("q"), ["g", "exam_id", "s2"])
    second = pairs.join(named(late, 2), ["exam_id", "s2"]).join(named(rows, 1).filter("not late1").drop("q"), ["g", "exam_id", "s1"])
    more = first.unionByName(second).filter("r1 or r2").withColumn("us", F.abs(F.col("t1") - F.col("t2")))
    if not once:                                          # seen from either side that is recent
        more = more.withColumn("times", F.when(F.col("r1") & F.col("r2"), 2).otherwise(1)).withColumn(
            "times", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return _added(met.unionByName(more.groupBy(*PAIR).agg(*_sums(n_questions))), PAIR)


def _prefix_found(m: Matches, min_matches: int, once: bool, cell_rows: int) -> DataFrame:
    """The pairs with ``min_matches`` by way of ``_prefix_pairs``, their questions by name."""
    most = m.groups.agg(F.max("q")).first()[0]
    n_questions = 1 if most is None else most + 1
    found = _prefix_pairs(m, prefixed(m, min_matches), once, cell_rows, n_questions).filter(F.col("n") >= min_matches)
    names = m.groups.groupBy("exam_id").agg(F.sort_array(F.collect_set(F.struct("q", "question_id"))).alias("names"))
    if "qs" in found.columns:
        held = F.filter("names", lambda x: F.array_contains("qs", x["q"]))
    else:
        masks = F.array(*[c for c in found.columns if c.startswith("m")])
        held = F.filter("names", lambda x: F.call_function(
            "shiftright", F.element_at(masks, F.floor(x["q"] / BITS).cast("int") + 1),
            F.pmod(x["q"], F.lit(BITS)).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1)
    held = F.transform(held, lambda x: x["question_id"])
    return found.join(names, "exam_id").withColumn("questions", held)


def match_counts(m: Matches, min_matches: int) -> dict:
    """Joined rows without and with the prefix filter, and the mean number of late groups of a student."""
    every = m.groups.agg(F.sum(F.col("_nl") * F.col("_nr"))).first()[0] or 0
    marked = prefixed(m, min_matches)
    rows = m.rows.join(marked, ["g", "exam_id", "s"])
    early = rows.filter("not late").groupBy("g").agg(F.count(F.lit(1)).alias("r"), F.count(F.when(F.col("recent"), 1)).alias("l"))
    kept = early.agg(F.sum(F.col("l") * F.col("r"))).first()[0] or 0
    ends = marked.groupBy("exam_id", "s").agg(F.count(F.when(F.col("late"), 1)).alias("k")).agg(F.avg("k")).first()[0] or 0.0
    return {"every": every, "prefix": kept, "late_groups": ends}


def collusion_pairs(attempts: DataFrame, as_of, lookback: str = "2 hours", min_matches: int = 3,
                    once: bool = False, cell_rows: int | None = None, prefix: bool | None = None) -> DataFrame:
    """J2 grouped by (student_1, student_2, exam): match count, average
    absolute time gap (s), sorted set of questions; count >= 3; similarity
    = count / 50; C2 risk level; ``detected_at`` = as_of.

    ``prefix`` joins only groups that are late for neither student (``prefixed``) and looks the
    late groups of the pairs found up afterwards; the result is the same.  By default it
    is taken where it joins fewer rows, look-ups included: at a low ``min_matches`` a student
    has few late groups, so it gains little there.
    """
    m = _matches(attempts, as_of, lookback)
    if prefix is None:
        c = match_counts(m, min_matches) if min_matches > 4 else None
        prefix = c is not None and c["prefix"] * (1 + 2 * c["late_groups"]) < c["every"]
    found = _prefix_found(m, min_matches, once, cell_rows or DEFAULT_CELL_ROWS) if prefix else _every_pair(m, min_matches, once, cell_rows)
    n = F.col("n")
    return found.select(
        F.col("s1").alias("student_1_id"), F.col("s2").alias("student_2_id"), "exam_id",
        n.alias("matching_questions_count"), (F.col("us") / n / 1e6).alias("avg_time_difference_seconds"),
        "questions", (n / 50).alias("similarity_score"), risk_level_collusion(n).alias("risk_level"),
        as_column(as_of).alias("detected_at"))


def answer_classes(attempts: DataFrame) -> DataFrame:
    """Students with identical answers in an exam (the same number of attempts for each question
    and hash) form a class, named by its least student id: (exam_id, student_id, class_id, class_size)."""
    m = answer_members(attempts.dropna(subset=[*GROUP, "student_id"]))
    sheet = F.array_sort(F.collect_list(F.struct("question_id", "answer_hash", "n")))     # one student's answers in an exam
    sheets = m.groupBy("exam_id", "student_id").agg(sheet.alias("sheet"))
    sheets = materialize(sheets, "sheets")
    classes = sheets.groupBy("exam_id", "sheet").agg(F.min("student_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return sheets.join(classes, ["exam_id", "sheet"]).select("exam_id", "student_id", "class_id", "class_size")


def answer_class_pairs(attempts: DataFrame, cell_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """A5 by class: (membership, pairs of classes).

    Every student of ``class_1`` has ``matching_questions`` matching attempt pairs with every other
    student of ``class_2``; ``links`` is the number of student pairs that stands for.  A class of
    several students is also paired with itself.
    """
    members = materialize(answer_classes(attempts), "classes")
    heads = members.filter("student_id = class_id").select("exam_id", "student_id", "class_size")
    alone = attempts.join(heads.select("exam_id", "student_id"), ["exam_id", "student_id"], "left_semi")
    sized = answer_members(alone).join(heads.withColumnRenamed("class_size", "a"), ["exam_id", "student_id"])   # sizes go with the rows
    across = _member_sums(sized, GROUP, ["exam_id"], cell_rows).select(
        "exam_id", F.col("s1").alias("class_1"), F.col("s2").alias("class_2"), F.col("n").alias("matching_questions"),
        (F.col("a1") * F.col("a2")).alias("links"))
    own = answer_members(alone.dropna(subset=GROUP)).join(heads.filter("class_size > 1"), ["exam_id", "student_id"])
    own = own.groupBy("exam_id", F.col("student_id").alias("class_1"), "class_size").agg(
        F.sum(F.col("n") * F.col("n")).alias("matching_questions"))
    own = own.select("exam_id", "class_1", F.col("class_1").alias("class_2"), "matching_questions",
                     F.expr("class_size * (class_size - 1) div 2").alias("links"))
    return members, across.unionByName(own)


def expand_class_pairs(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """The student pairs of A5 that class pairs stand for; ask for them where they are few."""
    side = lambda k: members.select("exam_id", F.col("class_id").alias(f"class_{k}"), F.col("student_id").alias(f"m{k}"))
    j = pairs.join(side(1), ["exam_id", "class_1"]).join(side(2), ["exam_id", "class_2"])
    j = j.filter("class_1 <> class_2 or m1 < m2")
    return j.select(F.least("m1", "m2").alias("student_1"), F.greatest("m1", "m2").alias("student_2"), "exam_id", "matching_questions")


def hash_groups(answers: DataFrame, group: list[str] = ("question_id", "answer_hash"),
                min_students: int = 2) -> DataFrame:
    """Members of every answer group with >= 2 distinct students.

    One row per (group, student): the group's representative (smallest
    student id), its number of distinct students and this student's number of
    answers in it.  Every pair of the original "all pairs, similarity 1.0"
    listing is implied by two rows of the same group.
    """
    group = list(group)
    m = answer_members(answers, group)
    sizes = (m.groupBy(*group)
             .agg(F.count(F.lit(1)).alias("group_size"), F.min("student_id").alias("representative"))
             .filter(F.col("group_size") >= min_students))
    return m.join(sizes, group).select(*group, "student_id", "representative", "group_size",
                                       F.col("n").alias("answers"))


def pair_suspicion(answers: DataFrame, threshold: int = 5,
                   cell_rows: int | None = None) -> DataFrame:
    """Student pairs sharing (question, hash) groups -> match count,
    sorted distinct questions, min(n / threshold, 1), C3 risk level."""
    g = ["question_id", "answer_hash"]
    agg = _member_sums(answer_members(answers, g), g, [], cell_rows, questions=True).withColumnsRenamed(
        {"s1": "student_1", "s2": "student_2", "n": "matching_questions"})
    score = suspicion_from_count("matching_questions", threshold)
    return agg.select("student_1", "student_2", "matching_questions", "questions",
                      score.alias("suspicion_score"),
                      risk_level_suspicion(score).alias("risk_level"))


def collusion_cases(attempts: DataFrame, as_of=None, lookback: str | None = "2 hours",
                    k_cases: int = 50, k_students: int = 5) -> DataFrame:
    """Answer groups with >= 2 rows and >= 2 distinct students, the
    first 5 students (sorted), the row count; 50 cases by count desc
    (ordered before the limit, quirk Q12)."""
    a = attempts
    if as_of is not None and lookback is not None:
        a = a.filter(_recent_flag(F.col("submission_timestamp"), as_of, lookback))
    m = answer_members(a)
    groups = (m.groupBy(*GROUP)
              .agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("n_students"))
              .filter((F.col("count") >= 2) & (F.col("n_students") >= 2)))
    # the case list is bounded by k_cases rows, so it is safe to broadcast
    top = F.broadcast(groups.orderBy(F.desc("count"), *GROUP).limit(k_cases))
    w = Window.partitionBy(*GROUP).orderBy("student_id")
    firsts = (m.join(top.select(*GROUP), GROUP)
              .withColumn("_rk", F.row_number().over(w))
              .filter(F.col("_rk") <= k_students)
              .groupBy(*GROUP)
              .agg(F.array_sort(F.collect_list("student_id")).alias("students")))
    return top.join(firsts, GROUP).select("exam_id", "question_id", "students", "count")
