"""Registered queries: archive (K1, K2, K4, K8, K10-K12, S2, A27, A28,
A33-A36) and KPI snapshot (K5-K7).

Archive queries write the eligible attempts (older than 48 h at ``as_of``)
to a fresh folder under the session's checkpoint directory and read the
archive back, so they exercise the real write/partition-discovery path.
"""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from probity import schemas
from probity.operators import archive as A, rollups, snapshot as S
from probity.plans.catalog import register
from probity.plans.q_rollups import A9_DOUBLES, _A9
from probity.session import work_dir

OLD = "submission_timestamp < (SELECT t FROM as_of) - INTERVAL 48 HOUR"
ARCHIVE_SQL = f"""
, arc AS (
  SELECT *, CAST(year(submission_timestamp) AS INTEGER) AS year,
         CAST(month(submission_timestamp) AS INTEGER) AS month,
         CAST(day(submission_timestamp) AS INTEGER) AS day
  FROM exam_attempts WHERE {OLD}
)"""
ATT_DOUBLES = ("response_time", "ai_usage_score")


def _archived(t):
    """Write the eligible rows once per table set and read the archive back."""
    if not hasattr(t, "_archive_path"):
        path = work_dir(t.spark, "archive")
        A.write_archive(A.eligible(t.attempts, "submission_timestamp", t.as_of), "submission_timestamp", path)
        t._archive_path = path
    return A.read_archive(t.spark, t._archive_path, schemas.EXAM_ATTEMPTS)


@register("write_archive", doubles=ATT_DOUBLES, sql=ARCHIVE_SQL + " SELECT * FROM arc")
def q_k1(t):
    return _archived(t)


@register("scan_archive_range", doubles=ATT_DOUBLES, sql=ARCHIVE_SQL + """
SELECT * FROM arc WHERE make_date(year, month, day) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""")
def q_s2(t):
    _archived(t)
    return A.read_archive(t.spark, t._archive_path, schemas.EXAM_ATTEMPTS,
                          dt.date(2024, 1, 10), dt.date(2024, 1, 12))


@register("archive_partitions", sql=ARCHIVE_SQL + " SELECT DISTINCT year, month, day FROM arc")
def q_a27(t):
    return A.archive_partitions(_archived(t))


@register("write_manifest", sql=ARCHIVE_SQL + """
SELECT CAST(sum(records) AS BIGINT) AS record_count,
       list_sort(list(format('year={}/month={}/day={}', year, month, day))) AS partitions
FROM (SELECT year, month, day, count(*) AS records FROM arc GROUP BY 1, 2, 3) p""")
def q_k8(t):
    arc = _archived(t)
    out = work_dir(t.spark, "manifest")
    A.write_manifest(arc, t._archive_path, out)          # one JSON document
    schema = "location string, record_count long, partitions array<string>"
    return t.spark.read.schema(schema).json(out).select("record_count", "partitions")


@register("delete_archived", sql=ARCHIVE_SQL + """
SELECT attempt_id, submission_timestamp FROM exam_attempts
WHERE attempt_id NOT IN (SELECT attempt_id FROM arc)""")
def q_k4(t):
    hot = A.retain_hot(t.attempts, _archived(t), "attempt_id")
    return hot.select("attempt_id", "submission_timestamp")


@register("archive_restore", sql=ARCHIVE_SQL + """
, hot AS (SELECT * FROM exam_attempts WHERE attempt_id NOT IN (SELECT attempt_id FROM arc))
SELECT attempt_id, submission_timestamp FROM hot
UNION ALL
SELECT attempt_id, submission_timestamp FROM arc
WHERE make_date(year, month, day) BETWEEN DATE '2024-01-20' AND DATE '2024-01-25'
  AND attempt_id NOT IN (SELECT attempt_id FROM hot)""")
def q_k10(t):
    arc = _archived(t)
    hot = A.retain_hot(t.attempts, arc, "attempt_id")
    r = A.restore(arc, hot, "attempt_id", dt.date(2024, 1, 20), dt.date(2024, 1, 25))
    return r.select("attempt_id", "submission_timestamp")


@register("archive_log", sql=ARCHIVE_SQL + """
SELECT (SELECT count(*) FROM arc) AS rows_archived, 'SUCCESS' AS status,
       (SELECT count(*) FROM exam_attempts WHERE attempt_id NOT IN (SELECT attempt_id FROM arc))
         AS remaining_rows""")
def q_k11(t):
    import time
    arc = _archived(t)
    log = A.log_run(t.spark, time.time(), arc, A.retain_hot(t.attempts, arc, "attempt_id"))
    return log.select("rows_archived", "status", "remaining_rows")


@register("register_archive", sql=ARCHIVE_SQL + """
SELECT year, month, day, count(*) AS records FROM arc GROUP BY 1, 2, 3""")
def q_k12(t):
    _archived(t)
    name = "archive_" + uuid.uuid4().hex[:10]
    A.register_archive(t.spark, name, t._archive_path, schemas.EXAM_ATTEMPTS)
    return t.spark.table(name).groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("records"))


@register("archive_eligibility", sql=f"""
SELECT count(*) > 0 AS eligible, count(*) AS n FROM exam_attempts WHERE {OLD}""")
def q_a28(t):
    return A.archive_eligibility(t.attempts, "submission_timestamp", t.as_of)


@register("archive_eligibility_facts", sql=f"""
SELECT 'exam_attempts' AS "table", count(*) > 0 AS eligible, count(*) AS n FROM exam_attempts WHERE {OLD}
UNION ALL
SELECT 'session_logs', count(*) > 0, count(*) FROM session_logs WHERE session_start < (SELECT t FROM as_of) - INTERVAL 48 HOUR""")
def q_a28_facts(t):
    """A28 for both facts."""
    facts = (("exam_attempts", t.attempts, "submission_timestamp"), ("session_logs", t.sessions, "session_start"))
    found = [A.archive_eligibility(df, ts, t.as_of).select(F.lit(n).alias("table"), "eligible", "n") for n, df, ts in facts]
    return found[0].unionByName(found[1])


@register("archive_monthly_trend", doubles=("avg_ai_score",), sql=ARCHIVE_SQL + """
SELECT year, month, avg(ai_usage_score) AS avg_ai_score, count(*) AS attempts FROM arc GROUP BY 1, 2""")
def q_a33(t):
    return A.monthly_trend(_archived(t))


@register("archive_student_history", doubles=("avg_response_time", "accuracy_rate"),
          sql=ARCHIVE_SQL + """
SELECT student_id, exam_id, avg(response_time) AS avg_response_time,
       avg(CAST(is_correct AS INTEGER)) * 100 AS accuracy_rate
FROM arc GROUP BY 1, 2""")
def q_a34(t):
    return A.student_history(_archived(t))


@register("archive_reconcile", doubles=("pct",), sql=ARCHIVE_SQL + f"""
SELECT 'exam_attempts' AS "table", n_hot, n_archived,
       CASE WHEN n_hot = 0 THEN (CASE WHEN n_archived = 0 THEN 0.0 ELSE 100.0 END)
            ELSE abs(n_hot - n_archived) / n_hot * 100 END AS pct,
       (CASE WHEN n_hot = 0 THEN (CASE WHEN n_archived = 0 THEN 0.0 ELSE 100.0 END)
            ELSE abs(n_hot - n_archived) / n_hot * 100 END) <= 0.1 AS ok
FROM (SELECT (SELECT count(*) FROM exam_attempts WHERE {OLD}) AS n_hot,
             (SELECT count(*) FROM arc) AS n_archived) c""")
def q_a35(t):
    ext = A.eligible(t.attempts, "submission_timestamp", t.as_of)
    return A.reconcile(ext, _archived(t), "exam_attempts")


@register("archive_quality", doubles=("completeness",), sql=ARCHIVE_SQL + """
SELECT avg(CASE WHEN attempt_id IS NULL OR student_id IS NULL OR exam_id IS NULL
                 OR ai_usage_score IS NULL THEN 0.0 ELSE 1.0 END) AS completeness,
       CAST(sum(CAST(attempt_id IS NULL AS INTEGER) + CAST(student_id IS NULL AS INTEGER)
                + CAST(exam_id IS NULL AS INTEGER) + CAST(ai_usage_score IS NULL AS INTEGER)) AS BIGINT)
         AS null_count,
       count(*) - count(DISTINCT attempt_id) AS duplicate_count
FROM arc""")
def q_a36(t):
    return A.archive_quality(_archived(t), "attempt_id",
                             ["attempt_id", "student_id", "exam_id", "ai_usage_score"])


@register("write_rollup", doubles=A9_DOUBLES, sql=_A9)
def q_k2(t):
    path = work_dir(t.spark, "rollup")
    A.write_rollup(rollups.aggregated_kpis(t.attempts, t.as_of, "7 days"), path)
    return A.read_rollup(t.spark, path)


_SNAP_SQL = """
, a AS (SELECT * FROM exam_attempts WHERE submission_timestamp >= (SELECT t FROM as_of) - INTERVAL 7 DAY),
ts AS (SELECT (SELECT t FROM as_of) AS w, (SELECT t FROM as_of) + INTERVAL 60 SECOND AS e),
hr AS (
  SELECT student_id, round(avg(ai_usage_score), 3) AS ai_score FROM a GROUP BY student_id
  HAVING avg(ai_usage_score) >= 0.7 ORDER BY avg(ai_usage_score) DESC, student_id LIMIT 20
),
cg AS (
  SELECT exam_id, question_id, answer_hash, count(*) AS count FROM a GROUP BY 1, 2, 3
  HAVING count(*) >= 2 AND count(DISTINCT student_id) >= 2
  ORDER BY count DESC, exam_id, question_id, answer_hash LIMIT 50
),
cases AS (
  SELECT cg.exam_id, cg.question_id, list_slice(list_sort(list(DISTINCT a.student_id)), 1, 5) AS students,
         cg.count
  FROM cg JOIN a ON cg.exam_id = a.exam_id AND cg.question_id = a.question_id AND cg.answer_hash = a.answer_hash
  GROUP BY cg.exam_id, cg.question_id, cg.answer_hash, cg.count
),
snap AS (
  SELECT 'kpi:avg_response_time:all' AS key, to_json({'value': round(avg(response_time), 2)}) AS value_json FROM a
  UNION ALL
  SELECT 'kpi:avg_response_time:exam:' || exam_id, to_json({'value': round(avg(response_time), 2)})
  FROM a GROUP BY exam_id
  UNION ALL
  SELECT 'kpi:accuracy_rate:all',
         to_json({'value': round(sum(CASE WHEN is_correct THEN 1 ELSE 0 END) / count(*) * 100, 2)}) FROM a
  UNION ALL
  SELECT 'kpi:ai_usage:' || label, to_json({'count': count(*)}) FROM (
    SELECT CASE WHEN ai_usage_score >= 0 AND ai_usage_score < 0.3 THEN 'low'
                WHEN ai_usage_score >= 0.3 AND ai_usage_score < 0.7 THEN 'medium'
                WHEN ai_usage_score >= 0.7 AND ai_usage_score < 1.0 THEN 'high' ELSE 'other' END AS label
    FROM a) b GROUP BY label
  UNION ALL
  SELECT 'kpi:high_risk_students',
         to_json({'students': coalesce(list({'student_id': student_id, 'ai_score': ai_score}
                                            ORDER BY ai_score DESC, student_id), []),
                  'count': count(*)}) FROM hr
  UNION ALL
  SELECT 'kpi:collusion_cases',
         to_json({'cases': coalesce(list({'exam_id': exam_id, 'question_id': question_id,
                                          'students': students, 'count': count}
                                         ORDER BY exam_id, question_id, students, count), []),
                  'total': count(*)}) FROM cases
)"""


def _snapshot(t):
    """The stored snapshot, written once per table set."""
    if not hasattr(t, "_snapshot"):
        t._snapshot = S.write_snapshot(S.kpi_snapshot(t.attempts, t.as_of, 60, "7 days"),
                                       work_dir(t.spark, "snapshot"))
    return t._snapshot


@register("kpi_snapshot_write", sql=_SNAP_SQL + """
SELECT key, CAST(value_json AS VARCHAR) AS value_json, (SELECT w FROM ts) AS written_at,
       (SELECT e FROM ts) AS expires_at FROM snap""")
def q_k5(t):
    return _snapshot(t)


@register("kpi_snapshot_read", sql=_SNAP_SQL + " SELECT key, CAST(value_json AS VARCHAR) AS value_json FROM snap")
def q_k6(t):
    later = t.as_of + F.make_dt_interval(secs=F.lit(30))
    return S.read_snapshot(_snapshot(t), later).select("key", "value_json")


@register("kpi_snapshot_freshness", doubles=("ttl_seconds",), sql=_SNAP_SQL + """
SELECT key, 5.0::DOUBLE AS ttl_seconds, 'evict' AS state FROM snap""")
def q_k7(t):
    later = t.as_of + F.make_dt_interval(secs=F.lit(55))
    return S.freshness(_snapshot(t), later)


@register("kpi_snapshot_health", doubles=("health",), sql=_SNAP_SQL + """
SELECT count(*) FILTER (WHERE key IN ('kpi:avg_response_time:all', 'kpi:accuracy_rate:all',
                                      'kpi:high_risk_students')) AS fresh,
       3 AS tracked,
       count(*) FILTER (WHERE key IN ('kpi:avg_response_time:all', 'kpi:accuracy_rate:all',
                                      'kpi:high_risk_students')) / 3 AS health
FROM snap""")
def q_k7_health(t):
    later = t.as_of + F.make_dt_interval(secs=F.lit(20))      # 40 s left: fresh
    return S.freshness_health(_snapshot(t), later, ["kpi:avg_response_time:all",
                                                    "kpi:accuracy_rate:all",
                                                    "kpi:high_risk_students"])
