"""Dashboard panels (G3-G15), BI queries (A29-A32), the star join (J10) and
``kpis_by`` over the ten analysis dimensions (D1-D10), plus W1/W2.

Windows only ever run over small aggregates (per exam x band, per exam), never
over raw rows; top-n selections use ``orderBy().limit()`` whose result size is
the n itself, so the following join may broadcast it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from probity.functions.exact import mean
from probity.functions.bands import risk_level_attempt, session_indicators
from probity.functions.timecols import bucket_start, recent

# --- star join and kpis_by -------------------------------------------------

# dimension column -> the dimension table that provides it
DIM_SOURCE = {
    "student_id": None, "exam_id": None, "question_id": None,
    "program": "students", "region": "students",
    "course_id": "exams", "exam_type": "exams",
    "department": "courses", "course_difficulty": "courses",
    "difficulty_level": "questions", "question_type": "questions",
    "device_type": "sessions",
    "hour": "time", "day": "time", "week": "time",
}


def star(attempts: DataFrame, students: DataFrame | None = None, exams: DataFrame | None = None,
         courses: DataFrame | None = None, questions: DataFrame | None = None,
         sessions: DataFrame | None = None, dims: list[str] | None = None) -> DataFrame:
    """Attempts left-joined to the dimension tables.

    Only the dimension tables that ``dims`` needs are joined (all when
    ``dims`` is None).  Left joins keep every attempt; the small dimension
    sides are broadcast by AQE from their runtime size.
    """
    need = set(DIM_SOURCE.get(d) for d in (dims or DIM_SOURCE))
    s = attempts
    if "students" in need and students is not None:
        s = s.join(students.select("student_id", "program", "region"), "student_id", "left")
    if ("exams" in need or "courses" in need) and exams is not None:
        s = s.join(exams.select("exam_id", "course_id", "exam_type"), "exam_id", "left")
    if "courses" in need and courses is not None:
        s = s.join(courses.select("course_id", "department",
                                  F.col("difficulty_level").alias("course_difficulty")),
                   "course_id", "left")
    if "questions" in need and questions is not None:
        s = s.join(questions.select("question_id", "difficulty_level", "question_type"),
                   "question_id", "left")
    if "sessions" in need and sessions is not None:
        dev = sessions.select("student_id", "exam_id", "device_type").distinct()
        s = s.join(dev, ["student_id", "exam_id"], "left")
    if "time" in need:
        ts = F.col("submission_timestamp")
        s = s.withColumns({"hour": F.date_trunc("hour", ts), "day": F.date_trunc("day", ts),
                           "week": F.date_trunc("week", ts)})
    return s


def kpi_aggs():
    return [mean("response_time").alias("avg_response_time"),
            (mean(F.when(F.col("is_correct"), 1).otherwise(0)) * 100).alias("accuracy_rate"),
            mean("ai_usage_score").alias("avg_ai_score"),
            F.stddev_pop("response_time").alias("response_variance"),
            F.count(F.lit(1)).alias("total_attempts")]


def kpis_by(star_df: DataFrame, dims: list[str]) -> DataFrame:
    """KPIs grouped by any subset of the analysis dimensions."""
    return star_df.groupBy(*dims).agg(*kpi_aggs())


# --- overview / heat map ---------------------------------------------------

def top10_suspicious(suspicion: DataFrame, k: int = 10) -> DataFrame:
    """Highest suspicion per student, top 10."""
    return (suspicion.groupBy("student_id").agg(F.max("suspicion_score").alias("suspicion_score"))
            .orderBy(F.desc("suspicion_score"), "student_id").limit(k))


def ai_by_program_risk(kpis: DataFrame, students: DataFrame) -> DataFrame:
    """Average AI score and pair count by program x risk level."""
    j = kpis.join(students.select("student_id", "program"), "student_id", "left")
    return j.groupBy("program", "risk_level").agg(mean("avg_ai_score").alias("avg_ai_score"),
                                                  F.count(F.lit(1)).alias("pairs"))


def ai_score_histogram(attempts: DataFrame, bins: int = 10) -> DataFrame:
    """Equal-width bins of the AI score over [0, 1] (1.0 in the last bin)."""
    b = F.least(F.floor(F.col("ai_usage_score") * bins), F.lit(bins - 1)).cast("int")
    return attempts.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))


def rt_vs_ai_points(kpis: DataFrame) -> DataFrame:
    """One (avg response time, avg AI score) point per pair."""
    return kpis.select("student_id", "exam_id", "avg_response_time", "avg_ai_score")


# --- collusion panels ------------------------------------------------------

def collusion_summary(pairs: DataFrame) -> DataFrame:
    """Total cases, high-risk (>= 10 matches) pairs, average matches."""
    return pairs.agg(F.count(F.lit(1)).alias("total_cases"),
                     F.count(F.when(F.col("risk_level") == "High", 1)).alias("high_similarity_pairs"),
                     mean("matching_questions_count").alias("avg_matching_questions"))


def top20_collusion_pairs(pairs: DataFrame, k: int = 20) -> DataFrame:
    """G8."""
    return (pairs.orderBy(F.desc("matching_questions_count"), "student_1_id", "student_2_id",
                          "exam_id").limit(k)
            .select("student_1_id", "student_2_id", "exam_id", "matching_questions_count",
                    "similarity_score", "risk_level"))


def collusion_by_exam(pairs: DataFrame) -> DataFrame:
    """G9."""
    return pairs.groupBy("exam_id").agg(F.count(F.lit(1)).alias("pairs"))


def time_gap_distribution(pairs: DataFrame, width_minutes: int = 10) -> DataFrame:
    """Pairs per ``width_minutes`` bucket of the average time gap."""
    b = (F.floor(F.col("avg_time_difference_seconds") / (60 * width_minutes)) * width_minutes)
    return pairs.groupBy(b.cast("long").alias("gap_minutes")).agg(F.count(F.lit(1)).alias("pairs"))


# --- session panels ----------------------------------------------------------

def session_averages(sessions: DataFrame) -> DataFrame:
    """G11."""
    return sessions.agg(mean("tab_switches").alias("avg_tab_switches"),
                        mean("focus_loss_count").alias("avg_focus_loss"),
                        mean("idle_time_seconds").alias("avg_idle_time"))


def distribution(sessions: DataFrame, column: str) -> DataFrame:
    """Sessions per device type or browser."""
    return sessions.groupBy(column).agg(F.count(F.lit(1)).alias("sessions"))


def tab_switches_over_time(sessions: DataFrame, bucket: str = "1 hour") -> DataFrame:
    """Average tab switches per time bucket of the session start."""
    return (sessions.groupBy(F.window("session_start", bucket)["start"].alias("bucket"))
            .agg(mean("tab_switches").alias("avg_tab_switches"),
                 F.count(F.lit(1)).alias("sessions")))


def session_flags(sessions: DataFrame, exams: DataFrame) -> DataFrame:
    """C10 on every session (idle share needs the exam duration)."""
    j = sessions.join(exams.select("exam_id", "duration_minutes"), "exam_id", "left")
    return j.select("log_id", "student_id", "exam_id", "tab_switches", "focus_loss_count",
                    "idle_time_seconds", *session_indicators())


def high_risk_sessions(sessions: DataFrame, exams: DataFrame) -> DataFrame:
    """Sessions breaching any C10 indicator."""
    f = session_flags(sessions, exams)
    return f.filter(F.col("excessive_tab_switches") | F.col("excessive_focus_loss")
                    | F.col("excessive_idle"))


# --- BI queries ---------------------------------------------------------------

def row_normalise(df: DataFrame, value: str, row_key: str, name: str = "share") -> DataFrame:
    """``value`` as a share of its row (``row_key``) total."""
    return df.withColumn(name, F.col(value) / F.sum(value).over(Window.partitionBy(row_key)))


def _window(attempts: DataFrame, as_of, lookback: str) -> DataFrame:
    """The attempts of the last ``lookback`` at ``as_of``; all of them without an ``as_of``."""
    return attempts if as_of is None else recent(attempts, "submission_timestamp", as_of, lookback)


def heatmap_exam_risk(attempts: DataFrame, as_of=None, lookback: str = "2 hours") -> DataFrame:
    """Distinct students per exam x C4 band, normalised by exam."""
    g = (_window(attempts, as_of, lookback).groupBy("exam_id", risk_level_attempt("ai_usage_score").alias("risk_level"))
         .agg(F.countDistinct("student_id").alias("student_count")))
    return row_normalise(g, "student_count", "exam_id")


def top_n_keys(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The ``n`` keys with the most rows (ties by key)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), key).limit(n).select(key))


def trend_top5_exams(attempts: DataFrame, minutes: int = 10, n: int = 5, as_of=None, lookback: str = "2 hours") -> DataFrame:
    """10-minute average AI score per exam, top 5 exams by attempts."""
    attempts = _window(attempts, as_of, lookback)
    top = F.broadcast(top_n_keys(attempts, "exam_id", n))  # n rows by construction
    a = attempts.join(top, "exam_id")
    return (a.groupBy(bucket_start("submission_timestamp", minutes).alias("bucket"), "exam_id")
            .agg(mean("ai_usage_score").alias("avg_ai_usage")))


def suspicious_leaderboard(attempts: DataFrame, k: int = 20, min_score: float = 0.5, as_of=None,
                           lookback: str = "2 hours") -> DataFrame:
    """0.6 * avg AI + 0.4 * (count(distinct case correct then 1) / n),
    > 0.5, top 20.  The distinct term is 0 or 1 (quirk Q21); the intended
    accuracy form is returned beside it."""
    # count(distinct case when correct then 1) is 1 if any attempt is correct,
    # else 0 -- i.e. a max, which needs no Expand / distinct aggregation
    g = _window(attempts, as_of, lookback).groupBy("student_id").agg(
        mean("ai_usage_score").alias("avg_ai"),
        F.max(F.when(F.col("is_correct"), 1).otherwise(0)).alias("dc"),
        F.count(F.lit(1)).alias("n"),
        mean(F.when(F.col("is_correct"), 1).otherwise(0)).alias("acc"))
    out = g.select("student_id",
                   (F.col("avg_ai") * 0.6 + (F.col("dc") / F.col("n")) * 0.4).alias("suspicion_score"),
                   (F.col("avg_ai") * 0.6 + F.col("acc") * 0.4).alias("suspicion_intended"))
    return (out.filter(F.col("suspicion_score") > min_score)
            .orderBy(F.desc("suspicion_score"), "student_id").limit(k))


def shared_answers(attempts: DataFrame) -> DataFrame:
    """Answer hashes used by >= 2 distinct students.

    ``matching_answers`` (count of distinct hashes per hash) is always 1
    (quirk Q22); ``students`` and ``attempts`` carry the information."""
    # grouped by the hash, its distinct count is 1 (0 for a null hash); only
    # the student count needs a distinct aggregation
    g = attempts.groupBy("answer_hash").agg(
        F.countDistinct("student_id").alias("students"),
        F.max(F.when(F.col("answer_hash").isNotNull(), 1).otherwise(0)).cast("long")
        .alias("matching_answers"),
        F.count(F.lit(1)).alias("attempts"))
    return g.filter(F.col("students") >= 2)

