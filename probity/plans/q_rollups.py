"""Registered queries: dashboard rollups.

Fixture convention: ``as_of`` is the newest event time (a scalar subquery)
and the rollup lookback is 7 days (2 hours leaves a handful of rows).
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from probity.operators import rollups
from probity.plans.catalog import register

RECENT_7D = "submission_timestamp >= (SELECT t FROM as_of) - INTERVAL 7 DAY"

_A9 = f"""
SELECT student_id, exam_id,
       avg(response_time) AS avg_response_time,
       avg(CASE WHEN is_correct THEN 1 ELSE 0 END) * 100 AS accuracy_rate,
       avg(ai_usage_score) AS avg_ai_score,
       stddev_pop(response_time) AS response_variance,
       count(*) AS total_attempts,
       max(submission_timestamp) AS last_updated,
       CASE WHEN avg(ai_usage_score) >= 0.7 THEN 'High'
            WHEN avg(ai_usage_score) >= 0.4 THEN 'Medium' ELSE 'Low' END AS risk_level
FROM exam_attempts WHERE {RECENT_7D}
GROUP BY student_id, exam_id"""

A9_DOUBLES = ("avg_response_time", "accuracy_rate", "avg_ai_score", "response_variance")


@register("aggregated_kpis", doubles=A9_DOUBLES, sql=_A9)
def q_a9(t):
    return rollups.aggregated_kpis(t.attempts, t.as_of, "7 days")


@register("time_series_kpis", doubles=("avg_ai_score", "avg_response_time"), sql=f"""
SELECT time_bucket(INTERVAL 5 MINUTE, submission_timestamp) AS timestamp, exam_id,
       avg(ai_usage_score) AS avg_ai_score, avg(response_time) AS avg_response_time,
       count(*) AS total_events
FROM exam_attempts WHERE {RECENT_7D}
GROUP BY 1, 2""")
def q_a10(t):
    return rollups.time_series_kpis(t.attempts, t.as_of, "7 days")


@register("ai_trend_10m_ordered", doubles=("avg_ai_score",), sql=f"""
SELECT row_number() OVER (ORDER BY timestamp) AS place, * FROM (
  SELECT time_bucket(INTERVAL 10 MINUTE, submission_timestamp) AS timestamp,
         round(avg(ai_usage_score), 3) AS avg_ai_score, count(*) AS count
  FROM exam_attempts WHERE {RECENT_7D} GROUP BY 1) s""")
def q_o2(t):
    """O2: the series oldest first; the place of a row is its place in the sorted result."""
    series = rollups.ai_trend(t.attempts, t.as_of, "7 days", ordered=True)
    place = F.row_number().over(Window.orderBy("timestamp")).alias("place")     # a row per 10 minutes of a week: few
    return series.select(place, "*")


@register("ai_trend_10m", doubles=("avg_ai_score",), sql=f"""
SELECT time_bucket(INTERVAL 10 MINUTE, submission_timestamp) AS timestamp,
       round(avg(ai_usage_score), 3) AS avg_ai_score, count(*) AS count
FROM exam_attempts WHERE {RECENT_7D}
GROUP BY 1""")
def q_a11(t):
    return rollups.ai_trend(t.attempts, t.as_of, "7 days")


@register("avg_response_time_all", doubles=("value",), sql="""
SELECT round(avg(response_time), 2) AS value FROM exam_attempts HAVING count(*) > 0""")
def q_a12(t):
    return rollups.avg_response_time_all(t.attempts)


@register("avg_response_time_by_exam", doubles=("value",), sql="""
SELECT exam_id, round(avg(response_time), 2) AS value FROM exam_attempts GROUP BY exam_id""")
def q_a13(t):
    return rollups.avg_response_time_by_exam(t.attempts)


@register("accuracy_rate_all", doubles=("value",), sql="""
SELECT round(sum(CASE WHEN is_correct THEN 1 ELSE 0 END) / count(*) * 100, 2) AS value
FROM exam_attempts HAVING count(*) > 0""")
def q_a14(t):
    return rollups.accuracy_rate_all(t.attempts)


_BUCKET = """CASE WHEN ai_usage_score >= 0 AND ai_usage_score < 0.3 THEN 'low'
                  WHEN ai_usage_score >= 0.3 AND ai_usage_score < 0.7 THEN 'medium'
                  WHEN ai_usage_score >= 0.7 AND ai_usage_score < 1.0 THEN 'high'
                  ELSE 'other' END"""


@register("ai_usage_buckets", sql=f"""
SELECT {_BUCKET} AS label, count(*) AS count FROM exam_attempts GROUP BY 1""")
def q_a15(t):
    return rollups.ai_usage_buckets(t.attempts)


@register("ai_usage_bucket_pct", doubles=("pct",), sql=f"""
SELECT bucket, count, count / sum(count) OVER () * 100 AS pct
FROM (SELECT {_BUCKET} AS bucket, count(*) AS count FROM exam_attempts GROUP BY 1) b""")
def q_a16(t):
    return rollups.ai_usage_bucket_pct(t.attempts)


@register("high_risk_students_top20", doubles=("ai_score",), sql="""
SELECT student_id, round(avg_ai, 3) AS ai_score, attempts FROM (
  SELECT student_id, avg(ai_usage_score) AS avg_ai, count(*) AS attempts
  FROM exam_attempts GROUP BY student_id HAVING avg(ai_usage_score) >= 0.7
  ORDER BY avg_ai DESC, student_id LIMIT 20) s""")
def q_a17(t):
    return rollups.high_risk_students_top(t.attempts, 20)


@register("high_risk_count", sql="""
SELECT count(*) AS value FROM (
  SELECT student_id FROM exam_attempts GROUP BY student_id HAVING avg(ai_usage_score) >= 0.7) s""")
def q_a18(t):
    return rollups.high_risk_count(t.attempts)


@register("top100_students_by_ai", doubles=("avg_ai_score",), sql="""
SELECT student_id, avg(ai_usage_score) AS avg_ai_score, count(*) AS count
FROM exam_attempts GROUP BY student_id ORDER BY avg_ai_score DESC, student_id LIMIT 100""")
def q_a22(t):
    return rollups.top_students_by_ai(t.attempts, 100)


@register("total_events", sql="SELECT count(*) AS value FROM exam_attempts")
def q_a23(t):
    return rollups.total_events(t.attempts)


@register("event_rate", doubles=("rate",), sql="""
SELECT count(*) / 2.0::DOUBLE AS rate, CASE WHEN count(*) / 2.0::DOUBLE < 500 THEN 'low' ELSE 'ok' END AS status
FROM exam_attempts WHERE submission_timestamp >= (SELECT t FROM as_of) - INTERVAL 2 MINUTE""")
def q_a24(t):
    return rollups.event_rate(t.attempts, t.as_of, 2)


@register("event_rate_5m", doubles=("rate",), sql="""
SELECT count(*) / 5.0::DOUBLE AS rate, CASE WHEN count(*) / 5.0::DOUBLE < 100 THEN 'low' ELSE 'ok' END AS status
FROM exam_attempts WHERE submission_timestamp >= (SELECT t FROM as_of) - INTERVAL 5 MINUTE""")
def q_a24_5m(t):
    """A24, smoke-test form: 5-minute window, 100 events/min threshold."""
    return rollups.event_rate(t.attempts, t.as_of, 5, low_rate=100.0)


@register("minimum_data_gate", sql="""
SELECT count(*) >= 100 AS ok, count(*) AS n FROM exam_attempts""")
def q_a25(t):
    return rollups.minimum_data_gate(t.attempts, 100)


@register("student_live_trend", doubles=("avg_score", "ai_usage"), sql="""
SELECT student_id, avg(ai_usage_score) AS avg_score, sum(ai_usage_score) AS ai_usage
FROM exam_attempts GROUP BY student_id""")
def q_a26(t):
    return rollups.student_live_trend(t.attempts)


_O5 = """
, k AS ({a9})
SELECT k.student_id, {name} AS student_name, {program} AS program, k.exam_id,
       {exam_name} AS exam_name, avg_ai_score, avg_response_time, accuracy_rate,
       total_attempts, last_updated
FROM k {how} JOIN students s ON k.student_id = s.student_id
       {how} JOIN exams e ON k.exam_id = e.exam_id
WHERE avg_ai_score >= 0.7
ORDER BY avg_ai_score DESC, k.student_id, k.exam_id LIMIT 50"""

_O5_DOUBLES = ("avg_ai_score", "avg_response_time", "accuracy_rate")


@register("high_risk_students_inner", doubles=_O5_DOUBLES, sql=_O5.format(
    a9=_A9, how="INNER", name="s.name", program="s.program", exam_name="e.exam_name"))
def q_o5_inner(t):
    k = rollups.aggregated_kpis(t.attempts, t.as_of, "7 days")
    return rollups.high_risk_students(k, t.students, t.exams, "inner")


@register("high_risk_students_outer", doubles=_O5_DOUBLES, sql=_O5.format(
    a9=_A9, how="LEFT", name="coalesce(s.name, 'Unknown')",
    program="coalesce(s.program, 'Unknown')", exam_name="coalesce(e.exam_name, 'Unknown')"))
def q_o5_outer(t):
    k = rollups.aggregated_kpis(t.attempts, t.as_of, "7 days")
    return rollups.high_risk_students(k, t.students, t.exams, "left")


@register("risk_level_distribution", sql=f"""
SELECT risk_level, count(*) AS pairs FROM ({_A9}) k GROUP BY risk_level""")
def q_g2(t):
    return rollups.risk_level_distribution(rollups.aggregated_kpis(t.attempts, t.as_of, "7 days"))
