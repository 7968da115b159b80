"""Registered queries: scans, projections, predicates and bands
(S1, S5, S6, P1, P2, F1-F5, C1-C11)."""

from pyspark.sql import functions as F

from probity.functions import bands as B
from probity.functions.timecols import older_than, recent
from probity.operators import collusion, kpis, rollups
from probity.plans.catalog import register
from probity.plans.q_rollups import _A9
from probity.sources.tables import scan_limit

ATT = "exam_attempts"


@register("scan_table", doubles=("response_time", "ai_usage_score"), sql=f"SELECT * FROM {ATT}")
def q_s1(t):
    return t.attempts


@register("scan_limit", doubles=("response_time",), sql=f"""
SELECT attempt_id, student_id, response_time FROM {ATT} ORDER BY attempt_id LIMIT 100""")
def q_s5(t):
    return scan_limit(t.attempts.select("attempt_id", "student_id", "response_time"), 100, ["attempt_id"])


@register("scan_by_key", doubles=("response_time",), sql=f"""
SELECT attempt_id, question_id, response_time FROM {ATT} WHERE exam_id = 'EXM_click'""")
def q_s6(t):
    return t.attempts.filter(F.col("exam_id") == "EXM_click").select("attempt_id", "question_id",
                                                                    "response_time")


@register("project_columns", sql=f"""
SELECT attempt_id AS id, student_id AS student, exam_id, question_id FROM {ATT}""")
def q_p1(t):
    return (t.attempts.drop("answer_text", "answer_hash")
            .select(F.col("attempt_id").alias("id"), F.col("student_id").alias("student"),
                    "exam_id", "question_id"))


@register("derive_columns", doubles=("ai_usage_score",), sql=f"""
SELECT attempt_id, ai_usage_score, ai_usage_score > 0.7 AS flagged,
       CASE WHEN ai_usage_score < 0.3 THEN 'Low Risk' WHEN ai_usage_score < 0.7 THEN 'Medium Risk'
            ELSE 'High Risk' END AS risk_level,
       CASE WHEN ai_usage_score > 0.85 THEN 'High' WHEN ai_usage_score >= 0.70 THEN 'Medium-high'
            WHEN ai_usage_score >= 0.50 THEN 'Medium' ELSE 'Low' END AS ai_band,
       CASE WHEN response_time BETWEEN 10 AND 30 THEN 'ai_fast' WHEN response_time BETWEEN 60 AND 180
            THEN 'normal' WHEN response_time BETWEEN 200 AND 300 THEN 'struggling'
            ELSE 'unclassified' END AS response_band
FROM {ATT}""")
def q_p2(t):
    return t.attempts.select(
        "attempt_id", "ai_usage_score",
        B.flag_attempt("ai_usage_score").alias("flagged"),
        B.risk_level_attempt("ai_usage_score").alias("risk_level"),
        B.ai_usage_band("ai_usage_score").alias("ai_band"),
        B.response_time_band("response_time").alias("response_band"))


@register("recent_window", sql=f"""
SELECT attempt_id, submission_timestamp FROM {ATT}
WHERE submission_timestamp >= (SELECT t FROM as_of) - INTERVAL 2 HOUR""")
def q_f1(t):
    return recent(t.attempts, "submission_timestamp", t.as_of, "2 hours").select(
        "attempt_id", "submission_timestamp")


@register("older_than", sql=f"""
SELECT attempt_id FROM {ATT} WHERE submission_timestamp < (SELECT t FROM as_of) - INTERVAL 48 HOUR""")
def q_f2(t):
    return older_than(t.attempts, "submission_timestamp", t.as_of, "48 hours").select("attempt_id")


@register("having_avg", doubles=("avg_ai",), sql=f"""
SELECT student_id, avg(ai_usage_score) AS avg_ai, count(*) AS attempts FROM {ATT}
GROUP BY student_id HAVING avg(ai_usage_score) >= 0.7""")
def q_f3(t):
    return rollups.student_ai(t.attempts).filter(F.col("avg_ai") >= 0.7)


@register("having_count", sql=f"""
SELECT exam_id, question_id, answer_hash, count(*) AS n FROM {ATT}
GROUP BY 1, 2, 3 HAVING count(*) >= 2""")
def q_f4(t):
    return (t.attempts.groupBy("exam_id", "question_id", "answer_hash")
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= 2))


@register("is_null", sql=f"""
SELECT attempt_id FROM {ATT}
WHERE student_id IS NULL OR exam_id IS NULL OR ai_usage_score IS NULL OR is_correct IS NULL""")
def q_f5(t):
    a = t.attempts
    return a.filter(F.col("student_id").isNull() | F.col("exam_id").isNull()
                    | F.col("ai_usage_score").isNull() | F.col("is_correct").isNull()).select("attempt_id")


@register("risk_bands_pairs", sql=f"""
SELECT student_id, exam_id, risk_level,
       CASE WHEN avg_ai_score > 0.85 THEN 'High' WHEN avg_ai_score >= 0.70 THEN 'Medium-high'
            WHEN avg_ai_score >= 0.50 THEN 'Medium' ELSE 'Low' END AS ai_band,
       CASE WHEN accuracy_rate >= 85 AND accuracy_rate <= 95 THEN 'ai_high'
            WHEN accuracy_rate >= 70 AND accuracy_rate < 85 THEN 'good'
            WHEN accuracy_rate >= 50 AND accuracy_rate < 70 THEN 'average'
            WHEN accuracy_rate >= 30 AND accuracy_rate < 50 THEN 'struggling'
            ELSE 'unclassified' END AS accuracy_band,
       CASE WHEN response_variance < 10 THEN 'automation'
            WHEN response_variance BETWEEN 30 AND 60 THEN 'human'
            WHEN response_variance > 100 THEN 'inconsistent' ELSE 'unclassified' END AS variance_band,
       CASE WHEN avg_response_time BETWEEN 10 AND 30 THEN 'ai_fast'
            WHEN avg_response_time BETWEEN 60 AND 180 THEN 'normal'
            WHEN avg_response_time BETWEEN 200 AND 300 THEN 'struggling'
            ELSE 'unclassified' END AS response_band
FROM ({_A9}) k""")
def q_c1(t):
    k = rollups.aggregated_kpis(t.attempts, t.as_of, "7 days")
    return k.select("student_id", "exam_id", "risk_level",
                    B.ai_usage_band("avg_ai_score").alias("ai_band"),
                    B.accuracy_band("accuracy_rate").alias("accuracy_band"),
                    B.variance_band("response_variance").alias("variance_band"),
                    B.response_time_band("avg_response_time").alias("response_band"))


@register("irregularity_bands", sql="""
SELECT log_id, CASE WHEN s > 0.60 THEN 'suspicious' WHEN s >= 0.40 THEN 'borderline' ELSE 'normal' END
         AS band,
       CASE WHEN least(s, 1.0) > 0.60 THEN 'suspicious' WHEN least(s, 1.0) >= 0.40 THEN 'borderline'
            ELSE 'normal' END AS band_clipped
FROM (SELECT log_id, tab_switches * 0.3::DOUBLE + focus_loss_count * 0.4::DOUBLE
             + (idle_time_seconds / 7200) * 0.3::DOUBLE AS s FROM session_logs) x""")
def q_c7(t):
    s = t.sessions.select("log_id", (F.col("tab_switches") * 0.3 + F.col("focus_loss_count") * 0.4
                                     + (F.col("idle_time_seconds") / 7200) * 0.3).alias("s"))
    return s.select("log_id", B.irregularity_band("s").alias("band"),
                    B.irregularity_band(F.least("s", F.lit(1.0))).alias("band_clipped"))


@register("suspicion_bands", sql="""
, k AS (
  SELECT student_id, exam_id, avg(ai_usage_score) AS a, stddev_samp(response_time) AS v
  FROM exam_attempts GROUP BY 1, 2
), irr AS (
  SELECT student_id, exam_id, tab_switches * 0.3::DOUBLE + focus_loss_count * 0.4::DOUBLE
         + (idle_time_seconds / 7200) * 0.3::DOUBLE AS i FROM session_logs
), j AS (
  SELECT k.student_id, k.exam_id, coalesce(a, 0) AS a, coalesce(v, 0) AS v, coalesce(i, 0) AS i
  FROM k LEFT JOIN irr ON k.student_id = irr.student_id AND k.exam_id = irr.exam_id
), s AS (
  SELECT student_id, exam_id,
         a * 0.4 + (1 - v / (SELECT coalesce(nullif(max(v), 0), 100) FROM j)) * 0.3 + i * 0.3 AS x
  FROM j
)
SELECT student_id, exam_id,
       CASE WHEN x < 0.30 THEN 'green' WHEN x < 0.70 THEN 'yellow' ELSE 'red' END AS suspicion_band
FROM s""")
def q_c6(t):
    return kpis.kpi_suspicion_banded(t.attempts, t.sessions).select("student_id", "exam_id",
                                                                   "suspicion_band")


@register("similarity_bands", sql="""
, p AS (
  SELECT a1.student_id AS student_1, a2.student_id AS student_2, a1.exam_id,
         count(DISTINCT a1.question_id) AS mqd
  FROM exam_attempts a1 JOIN exam_attempts a2
    ON a1.exam_id = a2.exam_id AND a1.question_id = a2.question_id
   AND a1.answer_hash = a2.answer_hash AND a1.student_id < a2.student_id
  GROUP BY 1, 2, 3
), ans AS (
  SELECT student_id, exam_id, count(DISTINCT question_id) AS answered FROM exam_attempts GROUP BY 1, 2
), j AS (
  SELECT p.student_1, p.student_2, p.exam_id, p.mqd / (x.answered + y.answered - p.mqd) AS s
  FROM p JOIN ans x ON x.student_id = p.student_1 AND x.exam_id = p.exam_id
         JOIN ans y ON y.student_id = p.student_2 AND y.exam_id = p.exam_id
)
SELECT student_1, student_2, exam_id,
       CASE WHEN s > 0.80 THEN 'strong' WHEN s >= 0.60 THEN 'possible' ELSE 'coincidental' END
         AS similarity_band
FROM j""")
def q_c8(t):
    j = collusion.answer_jaccard(t.attempts)
    return j.select("student_1", "student_2", "exam_id",
                    B.similarity_band("answer_jaccard").alias("similarity_band"))
