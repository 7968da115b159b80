"""Constraint rules: one violating row per rule family, quarantine reasons."""

import datetime as dt

from probity.operators import quality as Q
from probity import schemas


def test_session_rules_and_quarantine(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("L1", "S", "E", 1, 1.0, 1, 0, 0, "Desktop", "Chrome", "ip", t, t + dt.timedelta(1), 0),
            ("L2", "S", "E", -1, 1.0, 1, 0, 0, "Phone", "Chrome", "ip", t, t, 0)]
    s = spark.createDataFrame(rows, schemas.SESSION_LOGS)
    r = {x.log_id: list(x.reasons) for x in Q.quarantine_split(s, "session_logs").collect()}
    assert r["L1"] == []
    assert r["L2"] == ["enum:device_type", "end_after_start", "non_negative:tab_switches"]
    counts = {x.rule: x.violations for x in Q.table_rule_counts(s, "session_logs", Q.row_rules()).collect()}
    assert counts["enum:device_type"] == 1 and counts["required:log_id"] == 0


def test_unique_and_foreign_keys(spark):
    st = spark.createDataFrame([("S1", "a@b.c"), ("S1", "a@b.c"), ("S2", "bad")],
                               "student_id string, email string")
    att = spark.createDataFrame([("A1", "S1"), ("A2", "S9")], "attempt_id string, student_id string")
    orphans = [r.student_id for r in Q.orphans(att, "student_id", st, "student_id").collect()]
    assert orphans == ["S9"]
    rules = {x.rule: x.violations for x in Q.table_rule_counts(
        st, "students", [r for r in Q.row_rules() if r.name == "email_format"]).collect()}
    assert rules == {"email_format": 1}


def test_outliers_and_missing(spark):
    vals = [(f"a{i}", 10.0) for i in range(30)] + [("big", 1000.0), ("nul", None)]
    df = spark.createDataFrame(vals, "attempt_id string, response_time double")
    assert [r.attempt_id for r in Q.outlier_flags(df).collect()] == ["big"]
    mr = {r.column: r.missing_rate for r in Q.missing_rate(df).collect()}
    assert mr["response_time"] == 1 / 32 and mr["attempt_id"] == 0.0


def test_constraint_report_flags_each_planted_violation(spark):
    t = dt.datetime(2024, 1, 1)
    students = spark.createDataFrame(
        [("S1", "n", "a@b.co", "Data Science", 2, "Europe", 0.5, t),
         ("S1", None, "not-an-email", "Poetry", 9, "Mars", 1.5, t)], schemas.STUDENTS)
    courses = spark.createDataFrame([("C1", "c", "I", "i", 7, "Statistics", 0)], schemas.COURSES)
    exams = spark.createDataFrame([("E1", "C9", "e", t, 0, 100, "viva", True)], schemas.EXAMS)
    questions = spark.createDataFrame([("Q1", "E1", 1, 3, "MCQ", 5, 60, "x")], schemas.QUESTIONS)
    attempts = spark.createDataFrame(
        [("A1", "S7", "E1", "Q1", -1.0, True, 1.5, 0, 0, "short", "x", t, 9, False)],
        schemas.EXAM_ATTEMPTS)
    sessions = spark.createDataFrame(
        [("L1", "S1", "E1", 0, 0.0, 0, 0, 0, "Desktop", "Chrome", "ip", t, t + dt.timedelta(1), 0)],
        schemas.SESSION_LOGS)
    tables = {"students": students, "courses": courses, "exams": exams, "questions": questions,
              "exam_attempts": attempts, "session_logs": sessions}
    rep = {(r.table, r.rule): r.violations for r in Q.constraint_report(tables).collect()}
    planted = [("students", "required:name"), ("students", "enum:program"), ("students", "enum:region"),
               ("students", "range:academic_year"), ("students", "range:skill_level"),
               ("students", "email_format"), ("students", "unique:student_id"),
               ("courses", "range:difficulty_level"), ("courses", "credits_positive"),
               ("exams", "enum:exam_type"), ("exams", "duration_positive"), ("exams", "fk:course_id->courses"),
               ("exam_attempts", "range:response_time"), ("exam_attempts", "range:ai_usage_score"),
               ("exam_attempts", "hash_length_64"), ("exam_attempts", "marks_le_max"),
               ("exam_attempts", "fk:student_id->students")]
    for key in planted:
        assert rep[key] == 1, key
    clean = [k for k in rep if k not in planted]
    assert all(rep[k] == 0 for k in clean), [k for k in clean if rep[k]]


def test_every_relation_and_count_rule(spark):
    t = dt.datetime(2024, 1, 1)
    tables = {
        "students": spark.createDataFrame([], schemas.STUDENTS), "courses": spark.createDataFrame([], schemas.COURSES),
        "exams": spark.createDataFrame([("E1", "C9", "e", t, 5, 100, "quiz", True)], schemas.EXAMS),
        "questions": spark.createDataFrame([("Q1", "E8", 0, 3, "MCQ", 5, 0, "x")], schemas.QUESTIONS),
        "exam_attempts": spark.createDataFrame(
            [("A1", "S7", "E7", "Q7", 1.0, True, 0.5, -1, -2, "h" * 64, "x", t, -3, False)] * 2, schemas.EXAM_ATTEMPTS),
        "session_logs": spark.createDataFrame(
            [("L1", "S6", "E6", 0, 0.0, 0, 0, 0, "Desktop", "Chrome", "ip", t, t + dt.timedelta(1), 0)],
            schemas.SESSION_LOGS)}
    found = {(r.relation, r.key) for r in Q.fk_orphan_keys(tables).collect()}
    assert found == {("exams.course_id->courses", "C9"), ("questions.exam_id->exams", "E8"),
                     ("exam_attempts.student_id->students", "S7"), ("exam_attempts.exam_id->exams", "E7"),
                     ("exam_attempts.question_id->questions", "Q7"), ("session_logs.student_id->students", "S6"),
                     ("session_logs.exam_id->exams", "E6")}
    assert Q.fk_orphan_keys(tables).count() == 7
    broken = {x.rule for n in ("questions", "exam_attempts")
              for x in Q.table_rule_counts(tables[n], n, Q.row_rules()).collect() if x.violations}
    assert broken == {"question_number_positive", "expected_time_positive", "non_negative:keystroke_count",
                      "non_negative:paste_count", "non_negative:marks_obtained"}


def test_report_scans_each_fact_once(spark, monkeypatch):
    """The events table stands in three plans: kinds of questions, attempts, sessions."""
    from conftest import SF_SMALL
    from probity.plans import q_quality
    from probity.sources.tables import Tables
    scans = []

    def spy(real):
        def write(df, name):
            scans.append(df._jdf.queryExecution().optimizedPlan().toString().count("event_id#") > 0 or
                         df._jdf.queryExecution().executedPlan().toString().count("events.parquet"))
            return real(df, name)
        return write

    monkeypatch.setattr(Q, "materialize", spy(Q.materialize))
    monkeypatch.setattr(q_quality, "materialize", spy(q_quality.materialize))
    out = q_quality.Q.constraint_report(q_quality._tables_once(Tables(spark, SF_SMALL)))
    assert "events.parquet" not in out._jdf.queryExecution().executedPlan().toString()
    assert sum(map(bool, scans)) == 3


def test_report_counts_rows_of_hot_and_missing_keys(spark):
    """A key that many rows share, null keys and marks above the question's most."""
    t = dt.datetime(2024, 1, 1)
    row = lambda a, s, q, m: (a, s, "E1", q, 1.0, True, 0.5, 0, 0, "h" * 64, "x", t, m, False)
    attempts = [row(f"A{i}", "S1" if i % 2 else "S9", "Q1", i) for i in range(10)] + [row("A3", None, "Q1", 5), row("B", "S1", None, 99)]
    empty = {n: spark.createDataFrame([], s) for n, s in (("courses", schemas.COURSES), ("session_logs", schemas.SESSION_LOGS))}
    tables = {**empty, "students": spark.createDataFrame([("S1", "n", "a@b.co", "Physics", 2, "Europe", 0.5, t)], schemas.STUDENTS),
              "exams": spark.createDataFrame([("E1", None, "e", t, 5, 100, "quiz", True)], schemas.EXAMS),
              "questions": spark.createDataFrame([("Q1", "E1", 1, 3, "MCQ", 5, 60, "x"), ("Q1", "E1", 1, 3, "MCQ", 7, 60, "x")], schemas.QUESTIONS),
              "exam_attempts": spark.createDataFrame(attempts, schemas.EXAM_ATTEMPTS)}
    rep = {(r.table, r.rule): (r.checked, r.violations) for r in Q.constraint_report(tables).collect()}
    assert rep["exam_attempts", "fk:student_id->students"] == (12, 5)
    assert rep["exam_attempts", "fk:question_id->questions"] == (12, 0)
    most = max(r.max_marks for r in tables["questions"].collect())
    assert rep["exam_attempts", "marks_le_max"] == (12, sum(i > most for i in range(10)))
    assert rep["exam_attempts", "unique:attempt_id"] == (12, 1) and rep["questions", "unique:question_id"] == (2, 1)
    assert rep["session_logs", "fk:exam_id->exams"] == (0, 0) and rep["courses", "unique:course_id"] == (0, 0)
    assert rep["exams", "fk:course_id->courses"] == (1, 0)
