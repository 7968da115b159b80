"""Registered queries: the batch KPI job."""

from pyspark.sql import functions as F

from probity.operators import kpis
from probity.plans.catalog import register

_PAIR_GROUP = " FROM exam_attempts GROUP BY student_id, exam_id"


@register("kpi_avg_response_time", doubles=("avg_response_time",), sql=
          "SELECT student_id, exam_id, avg(response_time) AS avg_response_time" + _PAIR_GROUP)
def q_a1(t):
    return kpis.kpi_avg_response_time(t.attempts)


@register("kpi_accuracy_rate", doubles=("accuracy_rate",), sql=
          "SELECT student_id, exam_id, sum(CASE WHEN is_correct THEN 1 ELSE 0 END) / count(*) * 100"
          " AS accuracy_rate" + _PAIR_GROUP)
def q_a2(t):
    return kpis.kpi_accuracy_rate(t.attempts)


@register("kpi_response_variance", doubles=("response_variance",), sql=
          "SELECT student_id, exam_id, stddev_samp(response_time) AS response_variance" + _PAIR_GROUP)
def q_a3(t):
    return kpis.kpi_response_variance(t.attempts)


@register("kpi_ai_usage", doubles=("avg_ai_usage_score",), sql=
          "SELECT student_id, exam_id, avg(ai_usage_score) AS avg_ai_usage_score" + _PAIR_GROUP)
def q_a4(t):
    return kpis.kpi_ai_usage(t.attempts)


@register("kpi_session_irregularity", doubles=("irregularity_score", "irregularity_clipped"), sql="""
SELECT student_id, exam_id,
       tab_switches * 0.3::DOUBLE + focus_loss_count * 0.4::DOUBLE + (idle_time_seconds / 7200) * 0.3::DOUBLE AS irregularity_score,
       least(tab_switches * 0.3::DOUBLE + focus_loss_count * 0.4::DOUBLE + (idle_time_seconds / 7200) * 0.3::DOUBLE, 1.0)
         AS irregularity_clipped
FROM session_logs""")
def q_a6(t):
    return kpis.kpi_session_irregularity(t.sessions, clip=True)


_SUSPICION = """
, k AS (
  SELECT student_id, exam_id, avg(ai_usage_score) AS avg_ai_usage_score,
         stddev_samp(response_time) AS response_variance
  FROM exam_attempts GROUP BY student_id, exam_id
), irr AS (
  SELECT student_id, exam_id,
         tab_switches * 0.3::DOUBLE + focus_loss_count * 0.4::DOUBLE + (idle_time_seconds / 7200) * 0.3::DOUBLE AS irregularity_score
  FROM session_logs
), irr_x AS (
  SELECT student_id, exam_id, IRR_SELECT FROM irr IRR_GROUP
), j AS (
  SELECT k.student_id, k.exam_id, coalesce(k.avg_ai_usage_score, 0) AS avg_ai_usage_score,
         coalesce(k.response_variance, 0) AS response_variance,
         coalesce(i.irregularity_score, 0) AS irregularity_score
  FROM k LEFT JOIN irr_x i ON k.student_id = i.student_id AND k.exam_id = i.exam_id
), mv AS (
  SELECT coalesce(nullif(max(response_variance), 0), 100) AS m FROM j
)
SELECT student_id, exam_id,
       avg_ai_usage_score * 0.4 + (1 - response_variance / (SELECT m FROM mv)) * 0.3
       + irregularity_score * 0.3 AS suspicion_score
FROM j"""


@register("kpi_suspicion", doubles=("suspicion_score",), sql=_SUSPICION
          .replace("IRR_SELECT", "irregularity_score").replace("IRR_GROUP", ""))
def q_a7(t):
    return kpis.kpi_suspicion(t.attempts, t.sessions)


@register("kpi_suspicion_dedup", doubles=("suspicion_score",), sql=_SUSPICION
          .replace("IRR_SELECT", "max(irregularity_score) AS irregularity_score")
          .replace("IRR_GROUP", "GROUP BY student_id, exam_id"))
def q_a7d(t):
    return kpis.kpi_suspicion(t.attempts, t.sessions, dedup_sessions=True)


@register("kpi_left_join", doubles=("avg_ai_usage_score", "response_variance", "irregularity_score"),
          sql="""
, k AS (
  SELECT student_id, exam_id, avg(ai_usage_score) AS avg_ai_usage_score,
         stddev_samp(response_time) AS response_variance
  FROM exam_attempts GROUP BY student_id, exam_id
)
SELECT k.student_id, k.exam_id, coalesce(avg_ai_usage_score, 0) AS avg_ai_usage_score,
       coalesce(response_variance, 0) AS response_variance,
       coalesce(tab_switches * 0.3::DOUBLE + focus_loss_count * 0.4::DOUBLE + (idle_time_seconds / 7200) * 0.3::DOUBLE, 0)
         AS irregularity_score
FROM k LEFT JOIN session_logs s ON k.student_id = s.student_id AND k.exam_id = s.exam_id""")
def q_j5(t):
    ai = kpis.kpi_ai_usage(t.attempts)
    var = kpis.kpi_response_variance(t.attempts)
    return kpis.kpi_left_join(ai, var, kpis.kpi_session_irregularity(t.sessions))


@register("scalar_broadcast", doubles=("response_time", "max_response_time", "share_of_max"), sql="""
SELECT attempt_id, response_time, (SELECT max(response_time) FROM exam_attempts) AS max_response_time,
       response_time / (SELECT max(response_time) FROM exam_attempts) AS share_of_max
FROM exam_attempts""")
def q_j6(t):
    m = kpis.scalar_max(t.attempts, "response_time")
    return t.attempts.select("attempt_id", "response_time", m.alias("max_response_time"),
                             (F.col("response_time") / m).alias("share_of_max"))


@register("kpi_counts", sql="""
SELECT kpi, count(*) AS records
FROM (SELECT DISTINCT student_id, exam_id FROM exam_attempts) a,
     (SELECT unnest(['avg_response_time', 'accuracy_rate', 'response_variance', 'ai_usage_score']) AS kpi) n
GROUP BY kpi
UNION ALL
SELECT 'session_irregularity_score', count(*) FROM session_logs
UNION ALL
SELECT 'suspicion_confidence', count(*)
  FROM (SELECT DISTINCT student_id, exam_id FROM exam_attempts) k
  LEFT JOIN session_logs s USING (student_id, exam_id)""")
def q_a8(t):
    return kpis.kpi_counts(t.attempts, t.sessions)
