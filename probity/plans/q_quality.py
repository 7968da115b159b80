"""Registered queries: data quality (V1-V14), J8 and J9."""

from pyspark.sql import functions as F

from probity.operators import quality as Q
from probity.plans.catalog import register
from probity.session import materialize
from probity.sources.tables import _k, courses_from_events, exams_from_events, questions_from_events

TABLES = ["students", "courses", "exams", "questions", "exam_attempts", "session_logs"]


def _tables(t):
    return {"students": t.students, "courses": t.courses, "exams": t.exams,
            "questions": t.questions, "exam_attempts": t.attempts, "session_logs": t.sessions}


def _tables_once(t):
    """The six tables; the small ones come from one scan of the facts, one row per kind of question."""
    if not hasattr(t, "_parents"):
        kinds = t.events.select("event_type", F.pmod(_k(F.col("props")), F.lit(10)).alias("q")).distinct()
        kinds = materialize(kinds.select("event_type", F.to_json(F.struct(F.col("q").alias("k"))).alias("props")), "kinds")
        t._parents = {"exams": exams_from_events(kinds), "courses": courses_from_events(kinds), "questions": questions_from_events(kinds)}
    return {**_tables(t), **t._parents}


def _report_sql() -> str:
    parts = []
    for table in TABLES:
        rules = [r for r in Q.row_rules() if r.table == table]
        for r in rules:
            parts.append(f"SELECT '{table}' AS \"table\", '{r.name}' AS rule, count(*) AS checked, "
                         f"count(CASE WHEN {r.sql} THEN 1 END) AS violations FROM {table}")
    parts.append("SELECT 'exam_attempts', 'marks_le_max', count(*), "
                 "count(CASE WHEN a.marks_obtained > q.max_marks THEN 1 END) "
                 "FROM exam_attempts a LEFT JOIN questions q ON a.question_id = q.question_id")
    for table, key in Q.UNIQUE_KEYS:
        parts.append(f"SELECT '{table}', 'unique:{key}', CAST(coalesce(sum(n), 0) AS BIGINT), "
                     f"count(CASE WHEN n > 1 THEN 1 END) "
                     f"FROM (SELECT {key}, count(*) AS n FROM {table} GROUP BY {key}) g")
    for child, col, parent, key in Q.FOREIGN_KEYS:
        parts.append(f"SELECT '{child}', 'fk:{col}->{parent}', count(*), "
                     f"count(CASE WHEN c.{col} IS NOT NULL AND p.k IS NULL THEN 1 END) "
                     f"FROM {child} c LEFT JOIN (SELECT DISTINCT {key} AS k FROM {parent}) p "
                     f"ON c.{col} = p.k")
    return ("SELECT *, violations = 0 AS passed FROM (\n" + "\nUNION ALL\n".join(parts) + "\n) r")


@register("constraint_report", sql=_report_sql())
def q_v8(t):
    return Q.constraint_report(_tables_once(t))


@register("required_nulls", sql="""
SELECT 'exam_attempts' AS "table", 'student_id' AS field, count(*) FILTER (WHERE student_id IS NULL) AS nulls FROM exam_attempts
UNION ALL SELECT 'exam_attempts', 'exam_id', count(*) FILTER (WHERE exam_id IS NULL) FROM exam_attempts
UNION ALL SELECT 'exam_attempts', 'ai_usage_score', count(*) FILTER (WHERE ai_usage_score IS NULL) FROM exam_attempts
UNION ALL SELECT 'session_logs', 'student_id', count(*) FILTER (WHERE student_id IS NULL) FROM session_logs
UNION ALL SELECT 'session_logs', 'exam_id', count(*) FILTER (WHERE exam_id IS NULL) FROM session_logs""")
def q_v1(t):
    return Q.required_nulls(t.attempts, t.sessions)


def _reasons_sql(table: str) -> str:
    rules = [r for r in Q.row_rules() if r.table == table]
    items = ", ".join(f"CASE WHEN {r.sql} THEN '{r.name}' END" for r in rules)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


@register("quarantine_split", sql=f"""
SELECT log_id, {_reasons_sql("session_logs")} AS reasons,
       len({_reasons_sql("session_logs")}) = 0 AS valid
FROM session_logs""")
def q_v9(t):
    return Q.quarantine_split(t.sessions, "session_logs").select("log_id", "reasons", "valid")


@register("quarantine_all", sql="\nUNION ALL\n".join(
    f"SELECT '{n}' AS \"table\", CAST({Q.PRIMARY_KEYS[n]} AS VARCHAR) AS key, {_reasons_sql(n)} AS reasons, "
    f"len({_reasons_sql(n)}) = 0 AS valid FROM {n}" for n in TABLES))
def q_v9_all(t):
    """V9 for every table: one row per row, with the rules that it breaks."""
    return Q.quarantine(_tables_once(t))


@register("record_counts", sql="\nUNION ALL\n".join(
    f"SELECT '{n}' AS \"table\", count(*) AS records FROM {n}" for n in TABLES))
def q_v10(t):
    return Q.record_counts(_tables(t))


def _volume_sql() -> str:
    sums = " + ".join(f"(SELECT coalesce(sum({Q.estimated_row_bytes_sql(n)}), 0) FROM {n})"
                      for n in TABLES)
    mb = "(bytes / (1024 * 1024))"
    return f"""
SELECT bytes, {mb} AS size_mb,
       CASE WHEN {mb} < 300 THEN 'WARNING' WHEN {mb} > 600 THEN 'CRITICAL' ELSE 'OK' END AS level,
       {mb} >= 250 AS validation_pass, {mb} > 500 AS archive_trigger
FROM (SELECT CAST({sums} AS BIGINT) AS bytes) b"""


@register("volume_alert", doubles=("size_mb",), sql=_volume_sql())
def q_v11(t):
    return Q.volume_alert(_tables(t))


@register("outlier_flags", doubles=("response_time", "z_score"), sql="""
, st AS (SELECT avg(response_time) AS m, stddev_pop(response_time) AS s FROM exam_attempts)
SELECT attempt_id, response_time, (response_time - st.m) / st.s AS z_score
FROM exam_attempts, st WHERE abs(response_time - st.m) > 3 * st.s""")
def q_v12(t):
    return Q.outlier_flags(t.attempts)


@register("missing_rate", doubles=("missing_rate",), sql="\nUNION ALL\n".join(
    f"SELECT '{f.name}' AS \"column\", avg(CASE WHEN {f.name} IS NULL THEN 1 ELSE 0 END) AS missing_rate "
    f"FROM exam_attempts" for f in Q.schemas.EXAM_ATTEMPTS.fields))
def q_v13(t):
    return Q.missing_rate(t.attempts)


@register("distribution_summary", doubles=("mean", "std", "min", "max"), sql="""
SELECT exam_id, avg(response_time) AS mean, stddev_pop(response_time) AS std,
       min(response_time) AS min, max(response_time) AS max, count(response_time) AS count
FROM exam_attempts GROUP BY exam_id""")
def q_v14(t):
    return Q.distribution_summary(t.attempts, "response_time", ["exam_id"])


@register("fk_violations", sql="\nUNION ALL\n".join(
    f"SELECT '{child}.{col}->{parent}' AS relation, CAST({col} AS VARCHAR) AS key "
    f"FROM (SELECT DISTINCT {col} FROM {child} WHERE {col} IS NOT NULL) c "
    f"WHERE {col} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)"
    for child, col, parent, key in Q.FOREIGN_KEYS))
def q_j9(t):
    return Q.fk_orphan_keys(_tables_once(t))


@register("anti_join_keys", sql="""
SELECT s.student_id, s.name FROM students s
WHERE NOT EXISTS (SELECT 1 FROM exam_attempts a WHERE a.student_id = s.student_id)""")
def q_j8(t):
    return Q.anti_join_keys(t.students.select("student_id", "name"), t.attempts, ["student_id"])
