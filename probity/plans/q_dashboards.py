"""Registered queries: dashboard panels (G3-G15), BI queries (A29-A32),
the star join (J10) and ``kpis_by_*`` (D1-D10)."""

from pyspark.sql import functions as F

from probity.operators import collusion, dashboards as D, kpis, rollups
from probity.plans.catalog import register
from probity.plans.q_collusion import _A20
from probity.plans.q_kpis import _SUSPICION
from probity.plans.q_rollups import _A9

A20_SQL = _A20.format(extra="")


def _a9(t):
    return rollups.aggregated_kpis(t.attempts, t.as_of, "7 days")


def _a20(t):
    return collusion.collusion_pairs(t.attempts, t.as_of, "7 days")


@register("top10_suspicious", doubles=("suspicion_score",), sql=f"""
, s AS (WITH {_SUSPICION.replace("IRR_SELECT", "irregularity_score").replace("IRR_GROUP", "")
        .replace(", k AS (", "k AS (", 1)}
)
SELECT student_id, max(suspicion_score) AS suspicion_score FROM s
GROUP BY student_id ORDER BY suspicion_score DESC, student_id LIMIT 10""")
def q_g3(t):
    return D.top10_suspicious(kpis.kpi_suspicion(t.attempts, t.sessions))


@register("ai_by_program_risk", doubles=("avg_ai_score",), sql=f"""
SELECT s.program, k.risk_level, avg(k.avg_ai_score) AS avg_ai_score, count(*) AS pairs
FROM ({_A9}) k LEFT JOIN students s ON k.student_id = s.student_id
GROUP BY 1, 2""")
def q_g4(t):
    return D.ai_by_program_risk(_a9(t), t.students)


@register("ai_score_histogram", sql="""
SELECT CAST(least(floor(ai_usage_score * 10), 9) AS INTEGER) AS bin, count(*) AS count
FROM exam_attempts GROUP BY 1""")
def q_g5(t):
    return D.ai_score_histogram(t.attempts)


@register("rt_vs_ai_points", doubles=("avg_response_time", "avg_ai_score"), sql=f"""
SELECT student_id, exam_id, avg_response_time, avg_ai_score FROM ({_A9}) k""")
def q_g6(t):
    return D.rt_vs_ai_points(_a9(t))


@register("collusion_summary", doubles=("avg_matching_questions",), sql=f"""
, p AS ({A20_SQL.replace(", m AS (", "WITH m AS (", 1)})
SELECT count(*) AS total_cases, count(CASE WHEN risk_level = 'High' THEN 1 END) AS high_similarity_pairs,
       avg(matching_questions_count) AS avg_matching_questions FROM p""")
def q_g7(t):
    return D.collusion_summary(_a20(t))


@register("top20_collusion_pairs", doubles=("similarity_score",), sql=f"""
, p AS ({A20_SQL.replace(", m AS (", "WITH m AS (", 1)})
SELECT student_1_id, student_2_id, exam_id, matching_questions_count, similarity_score, risk_level
FROM p ORDER BY matching_questions_count DESC, student_1_id, student_2_id, exam_id LIMIT 20""")
def q_g8(t):
    return D.top20_collusion_pairs(_a20(t))


@register("collusion_by_exam", sql=f"""
, p AS ({A20_SQL.replace(", m AS (", "WITH m AS (", 1)})
SELECT exam_id, count(*) AS pairs FROM p GROUP BY exam_id""")
def q_g9(t):
    return D.collusion_by_exam(_a20(t))


@register("time_gap_distribution", sql=f"""
, p AS ({A20_SQL.replace(", m AS (", "WITH m AS (", 1)})
SELECT CAST(floor(avg_time_difference_seconds / 600) * 10 AS BIGINT) AS gap_minutes, count(*) AS pairs
FROM p GROUP BY 1""")
def q_g10(t):
    return D.time_gap_distribution(_a20(t))


@register("session_averages", doubles=("avg_tab_switches", "avg_focus_loss", "avg_idle_time"), sql="""
SELECT avg(tab_switches) AS avg_tab_switches, avg(focus_loss_count) AS avg_focus_loss,
       avg(idle_time_seconds) AS avg_idle_time FROM session_logs""")
def q_g11(t):
    return D.session_averages(t.sessions)


@register("device_distribution", sql="""
SELECT device_type, count(*) AS sessions FROM session_logs GROUP BY 1""")
def q_g12(t):
    return D.distribution(t.sessions, "device_type")


@register("browser_distribution", sql="""
SELECT browser, count(*) AS sessions FROM session_logs GROUP BY 1""")
def q_g13(t):
    return D.distribution(t.sessions, "browser")


@register("tab_switches_over_time", doubles=("avg_tab_switches",), sql="""
SELECT time_bucket(INTERVAL 1 HOUR, session_start) AS bucket, avg(tab_switches) AS avg_tab_switches,
       count(*) AS sessions FROM session_logs GROUP BY 1""")
def q_g14(t):
    return D.tab_switches_over_time(t.sessions)


_FLAGS = """
SELECT log_id, student_id, s.exam_id, tab_switches, focus_loss_count, idle_time_seconds,
       tab_switches > 10 AS excessive_tab_switches, focus_loss_count > 5 AS excessive_focus_loss,
       idle_time_seconds > duration_minutes * 60 * 0.3 AS excessive_idle
FROM session_logs s LEFT JOIN exams e ON s.exam_id = e.exam_id"""


@register("session_indicators", doubles=("idle_time_seconds",), sql=_FLAGS)
def q_c10(t):
    return D.session_flags(t.sessions, t.exams)


@register("high_risk_sessions", doubles=("idle_time_seconds",), sql=f"""
SELECT * FROM ({_FLAGS}) f WHERE excessive_tab_switches OR excessive_focus_loss OR excessive_idle""")
def q_g15(t):
    return D.high_risk_sessions(t.sessions, t.exams)


@register("heatmap_exam_risk", doubles=("share",), sql="""
SELECT exam_id, risk_level, student_count, student_count / sum(student_count) OVER (PARTITION BY exam_id) AS share
FROM (SELECT exam_id, CASE WHEN ai_usage_score < 0.3 THEN 'Low Risk' WHEN ai_usage_score < 0.7
             THEN 'Medium Risk' ELSE 'High Risk' END AS risk_level,
             count(DISTINCT student_id) AS student_count
      FROM exam_attempts GROUP BY 1, 2) g""")
def q_a29(t):
    return D.heatmap_exam_risk(t.attempts)


@register("trend_top5_exams", doubles=("avg_ai_usage",), sql="""
, top AS (
  SELECT exam_id FROM exam_attempts GROUP BY exam_id ORDER BY count(*) DESC, exam_id LIMIT 5
)
SELECT time_bucket(INTERVAL 10 MINUTE, submission_timestamp) AS bucket, a.exam_id,
       avg(ai_usage_score) AS avg_ai_usage
FROM exam_attempts a JOIN top ON a.exam_id = top.exam_id GROUP BY 1, 2""")
def q_a30(t):
    return D.trend_top5_exams(t.attempts)


@register("suspicious_leaderboard", doubles=("suspicion_score", "suspicion_intended"), sql="""
SELECT student_id,
       avg(ai_usage_score) * 0.6 + (count(DISTINCT CASE WHEN is_correct THEN 1 END) / count(*)) * 0.4
         AS suspicion_score,
       avg(ai_usage_score) * 0.6 + avg(CASE WHEN is_correct THEN 1 ELSE 0 END) * 0.4 AS suspicion_intended
FROM exam_attempts GROUP BY student_id
HAVING avg(ai_usage_score) * 0.6 + (count(DISTINCT CASE WHEN is_correct THEN 1 END) / count(*)) * 0.4 > 0.5
ORDER BY suspicion_score DESC, student_id LIMIT 20""")
def q_a31(t):
    return D.suspicious_leaderboard(t.attempts)


_2H = ", last2h AS (SELECT * FROM exam_attempts WHERE submission_timestamp >= (SELECT t FROM as_of) - INTERVAL 2 HOUR)"


@register("heatmap_exam_risk_2h", doubles=("share",), sql=_2H + """
SELECT exam_id, risk_level, student_count, student_count / sum(student_count) OVER (PARTITION BY exam_id) AS share
FROM (SELECT exam_id, CASE WHEN ai_usage_score < 0.3 THEN 'Low Risk' WHEN ai_usage_score < 0.7
             THEN 'Medium Risk' ELSE 'High Risk' END AS risk_level,
             count(DISTINCT student_id) AS student_count
      FROM last2h GROUP BY 1, 2) g""")
def q_a29_2h(t):
    return D.heatmap_exam_risk(t.attempts, t.as_of)


@register("trend_top5_exams_2h", doubles=("avg_ai_usage",), sql=_2H + """
, top AS (SELECT exam_id FROM last2h GROUP BY exam_id ORDER BY count(*) DESC, exam_id LIMIT 5)
SELECT time_bucket(INTERVAL 10 MINUTE, submission_timestamp) AS bucket, a.exam_id,
       avg(ai_usage_score) AS avg_ai_usage
FROM last2h a JOIN top ON a.exam_id = top.exam_id GROUP BY 1, 2""")
def q_a30_2h(t):
    return D.trend_top5_exams(t.attempts, as_of=t.as_of)


@register("suspicious_leaderboard_2h", doubles=("suspicion_score", "suspicion_intended"), sql=_2H + """
SELECT student_id,
       avg(ai_usage_score) * 0.6 + (count(DISTINCT CASE WHEN is_correct THEN 1 END) / count(*)) * 0.4
         AS suspicion_score,
       avg(ai_usage_score) * 0.6 + avg(CASE WHEN is_correct THEN 1 ELSE 0 END) * 0.4 AS suspicion_intended
FROM last2h GROUP BY student_id
HAVING avg(ai_usage_score) * 0.6 + (count(DISTINCT CASE WHEN is_correct THEN 1 END) / count(*)) * 0.4 > 0.5
ORDER BY suspicion_score DESC, student_id LIMIT 20""")
def q_a31_2h(t):
    return D.suspicious_leaderboard(t.attempts, as_of=t.as_of)


@register("shared_answers", sql="""
SELECT answer_hash, count(DISTINCT student_id) AS students, count(DISTINCT answer_hash) AS matching_answers,
       count(*) AS attempts
FROM exam_attempts GROUP BY answer_hash HAVING count(DISTINCT student_id) >= 2""")
def q_a32(t):
    return D.shared_answers(t.attempts)


@register("star_join", doubles=("response_time", "ai_usage_score"), sql="""
SELECT a.attempt_id, a.student_id, a.exam_id, a.question_id, a.response_time, a.ai_usage_score,
       s.program, s.region, e.course_id, e.exam_type, c.department,
       c.difficulty_level AS course_difficulty, q.difficulty_level, q.question_type, d.device_type,
       date_trunc('hour', a.submission_timestamp) AS hour
FROM exam_attempts a
LEFT JOIN students s ON a.student_id = s.student_id
LEFT JOIN exams e ON a.exam_id = e.exam_id
LEFT JOIN courses c ON e.course_id = c.course_id
LEFT JOIN questions q ON a.question_id = q.question_id
LEFT JOIN (SELECT DISTINCT student_id, exam_id, device_type FROM session_logs) d
  ON a.student_id = d.student_id AND a.exam_id = d.exam_id""")
def q_j10(t):
    s = D.star(t.attempts, t.students, t.exams, t.courses, t.questions, t.sessions)
    return s.select("attempt_id", "student_id", "exam_id", "question_id", "response_time",
                    "ai_usage_score", "program", "region", "course_id", "exam_type", "department",
                    "course_difficulty", "difficulty_level", "question_type", "device_type",
                    F.col("hour").cast("timestamp_ntz").alias("hour"))


_KPI_AGGS = """avg(response_time) AS avg_response_time,
       avg(CASE WHEN is_correct THEN 1 ELSE 0 END) * 100 AS accuracy_rate,
       avg(ai_usage_score) AS avg_ai_score, stddev_pop(response_time) AS response_variance,
       count(*) AS total_attempts"""

# name -> (dimension column, SQL expression, SQL join)
_DIMS = {
    "course": ("course_id", "e.course_id", "LEFT JOIN exams e ON a.exam_id = e.exam_id"),
    "program": ("program", "s.program", "LEFT JOIN students s ON a.student_id = s.student_id"),
    "region": ("region", "s.region", "LEFT JOIN students s ON a.student_id = s.student_id"),
    "difficulty": ("difficulty_level", "q.difficulty_level",
                   "LEFT JOIN questions q ON a.question_id = q.question_id"),
    "hour": ("hour", "date_trunc('hour', a.submission_timestamp)", ""),
    "day": ("day", "date_trunc('day', a.submission_timestamp)", ""),
    "week": ("week", "date_trunc('week', a.submission_timestamp)", ""),
    "device": ("device_type", "d.device_type",
               "LEFT JOIN (SELECT DISTINCT student_id, exam_id, device_type FROM session_logs) d"
               " ON a.student_id = d.student_id AND a.exam_id = d.exam_id"),
    "exam_type": ("exam_type", "e.exam_type", "LEFT JOIN exams e ON a.exam_id = e.exam_id"),
    "question_type": ("question_type", "q.question_type",
                      "LEFT JOIN questions q ON a.question_id = q.question_id"),
    "student": ("student_id", "a.student_id", ""),
    "exam": ("exam_id", "a.exam_id", ""),
}

_KPI_DOUBLES = ("avg_response_time", "accuracy_rate", "avg_ai_score", "response_variance")


def _kpis_by(dim):
    def build(t):
        s = D.star(t.attempts, t.students, t.exams, t.courses, t.questions, t.sessions, dims=[dim])
        out = D.kpis_by(s, [dim])
        if dim in ("hour", "day", "week"):
            out = out.withColumn(dim, F.col(dim).cast("timestamp_ntz"))
        return out
    return build


for _name, (_col, _expr, _join) in _DIMS.items():
    register(f"kpis_by_{_name}", doubles=_KPI_DOUBLES, sql=f"""
SELECT {_expr} AS {_col}, {_KPI_AGGS}
FROM exam_attempts a {_join} GROUP BY 1""")(_kpis_by(_col))
