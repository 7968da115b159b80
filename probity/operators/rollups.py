"""Dashboard rollups over exam attempts.

Each is one grouped aggregate (partial + final, one shuffle on the grouping
keys) plus projections; top-k uses ``orderBy(...).limit(k)`` which plans as
``TakeOrderedAndProject`` (per-task top-k, k rows per task to the merge).
Ties in every top-k are broken by the key, ascending (quirk Q11).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from probity.functions.exact import mean, total
from probity.functions.bands import ai_usage_bucket, risk_level_pair
from probity.functions.timecols import bucket_start, recent

PAIR = ["student_id", "exam_id"]


def aggregated_kpis(attempts: DataFrame, as_of=None, lookback: str | None = "7 days") -> DataFrame:
    """Per (student, exam) rollup with population stddev and risk level."""
    a = attempts if as_of is None or lookback is None else recent(
        attempts, "submission_timestamp", as_of, lookback)
    g = a.groupBy(*PAIR).agg(
        mean("response_time").alias("avg_response_time"),
        (mean(F.when(F.col("is_correct"), 1).otherwise(0)) * 100).alias("accuracy_rate"),
        mean("ai_usage_score").alias("avg_ai_score"),
        F.stddev_pop("response_time").alias("response_variance"),
        F.count(F.lit(1)).alias("total_attempts"),
        F.max("submission_timestamp").alias("last_updated"),
    )
    return g.withColumn("risk_level", risk_level_pair("avg_ai_score"))


def time_series_kpis(attempts: DataFrame, as_of=None, lookback: str | None = "7 days",
                     minutes: int = 5, ordered: bool = False) -> DataFrame:
    """A10: (bucket, exam) averages and counts.  ``ordered=True`` returns the
    dashboard order (newest bucket first) at the price of a range shuffle; a
    published table does not need it."""
    a = attempts if as_of is None or lookback is None else recent(
        attempts, "submission_timestamp", as_of, lookback)
    out = (a.groupBy(bucket_start("submission_timestamp", minutes).alias("timestamp"), "exam_id")
           .agg(mean("ai_usage_score").alias("avg_ai_score"),
                mean("response_time").alias("avg_response_time"),
                F.count(F.lit(1)).alias("total_events")))
    return out.orderBy(F.desc("timestamp"), "exam_id") if ordered else out


def ai_trend(attempts: DataFrame, as_of=None, lookback: str | None = "2 hours",
             minutes: int = 10, ordered: bool = False) -> DataFrame:
    """10-minute buckets of average AI score (round 3) and count;
    ``ordered=True`` sorts oldest first for display."""
    a = attempts if as_of is None or lookback is None else recent(
        attempts, "submission_timestamp", as_of, lookback)
    out = (a.groupBy(bucket_start("submission_timestamp", minutes).alias("timestamp"))
           .agg(F.round(mean("ai_usage_score"), 3).alias("avg_ai_score"),
                F.count(F.lit(1)).alias("count")))
    return out.orderBy("timestamp") if ordered else out


def avg_response_time_all(attempts: DataFrame, empty_as_zero: bool = False) -> DataFrame:
    """Global average response time, round 2.  No row on empty input
    (or one row with 0 when ``empty_as_zero``)."""
    g = attempts.agg(mean("response_time").alias("avg"), F.count(F.lit(1)).alias("n"))
    if empty_as_zero:
        return g.select(F.round(F.coalesce(F.col("avg"), F.lit(0.0)), 2).alias("value"))
    return g.filter(F.col("n") > 0).select(F.round("avg", 2).alias("value"))


def avg_response_time_by_exam(attempts: DataFrame) -> DataFrame:
    """A13."""
    return attempts.groupBy("exam_id").agg(F.round(mean("response_time"), 2).alias("value"))


def accuracy_rate_all(attempts: DataFrame) -> DataFrame:
    """Global percent correct, round 2 (no row on empty input)."""
    g = attempts.agg(F.sum(F.when(F.col("is_correct"), 1).otherwise(0)).alias("correct"),
                     F.count(F.lit(1)).alias("total"))
    return g.filter(F.col("total") > 0).select(
        F.round(F.col("correct") / F.col("total") * 100, 2).alias("value"))


def ai_usage_buckets(attempts: DataFrame) -> DataFrame:
    """Attempts per AI-score bucket (only non-empty buckets appear)."""
    return (attempts.groupBy(ai_usage_bucket("ai_usage_score").alias("label"))
            .agg(F.count(F.lit(1)).alias("count")))


def ai_usage_bucket_pct(attempts: DataFrame) -> DataFrame:
    """A16 + W3: bucket counts with percent of all attempts.

    The window runs over the <= 4-row aggregate, never over raw rows.
    """
    b = ai_usage_buckets(attempts).withColumnRenamed("label", "bucket")
    total = F.sum("count").over(Window.partitionBy())
    return b.withColumn("pct", F.col("count") / total * 100)


def student_ai(attempts: DataFrame) -> DataFrame:
    return attempts.groupBy("student_id").agg(
        mean("ai_usage_score").alias("avg_ai"), F.count(F.lit(1)).alias("attempts"))


def high_risk_students_top(attempts: DataFrame, k: int = 20, threshold: float = 0.7) -> DataFrame:
    """Students with average AI score >= 0.7, highest first, top k."""
    s = student_ai(attempts).filter(F.col("avg_ai") >= threshold)
    return (s.orderBy(F.desc("avg_ai"), "student_id").limit(k)
            .select("student_id", F.round("avg_ai", 3).alias("ai_score"), "attempts"))


def high_risk_count(attempts: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Number of students with average AI score >= 0.7."""
    return (student_ai(attempts).filter(F.col("avg_ai") >= threshold)
            .agg(F.count(F.lit(1)).alias("value")))


def top_students_by_ai(attempts: DataFrame, k: int = 100) -> DataFrame:
    """Top 100 students by average AI score."""
    return (attempts.groupBy("student_id")
            .agg(mean("ai_usage_score").alias("avg_ai_score"), F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("avg_ai_score"), "student_id").limit(k))


def total_events(attempts: DataFrame) -> DataFrame:
    """A23."""
    return attempts.agg(F.count(F.lit(1)).alias("value"))


def event_rate(attempts: DataFrame, as_of, window_minutes: int = 2,
               low_rate: float = 500.0) -> DataFrame:
    """Events per minute over the last ``window_minutes``; below
    ``low_rate`` the status is ``low``."""
    r = recent(attempts, "submission_timestamp", as_of, f"{window_minutes} minutes")
    rate = F.count(F.lit(1)) / F.lit(float(window_minutes))
    return r.agg(rate.alias("rate")).withColumn(
        "status", F.when(F.col("rate") < low_rate, "low").otherwise("ok"))


def minimum_data_gate(attempts: DataFrame, minimum: int = 100) -> DataFrame:
    """Ok when at least ``minimum`` attempts exist."""
    return attempts.agg(F.count(F.lit(1)).alias("n")).select(
        (F.col("n") >= minimum).alias("ok"), "n")


def student_live_trend(attempts: DataFrame) -> DataFrame:
    """Per student average and sum of the AI score."""
    return attempts.groupBy("student_id").agg(
        mean("ai_usage_score").alias("avg_score"), total("ai_usage_score").alias("ai_usage"))


def high_risk_students(kpis: DataFrame, students: DataFrame, exams: DataFrame,
                       how: str = "inner", k: int = 50, threshold: float = 0.7,
                       with_last_updated: bool = True) -> DataFrame:
    """O5 with J3 (``how="inner"``) or J4 (``how="left"``, missing -> 'Unknown').

    ``kpis`` is the A9 rollup.  The filter runs before the joins, so only
    high-risk rows reach them; dimension sides are left to AQE, which
    broadcasts them when their runtime size is small.
    """
    h = kpis.filter(F.col("avg_ai_score") >= threshold)
    st = students.select("student_id", F.col("name").alias("student_name"), "program")
    ex = exams.select("exam_id", "exam_name")
    j = h.join(st, "student_id", how).join(ex, "exam_id", how)
    if how != "inner":
        j = j.select(*[c for c in j.columns if c not in ("student_name", "program", "exam_name")],
                     *[F.coalesce(F.col(c), F.lit("Unknown")).alias(c)
                       for c in ("student_name", "program", "exam_name")])
    cols = ["student_id", "student_name", "program", "exam_id", "exam_name", "avg_ai_score",
            "avg_response_time", "accuracy_rate", "total_attempts"]
    if with_last_updated:
        cols.append("last_updated")
    return j.select(*cols).orderBy(F.desc("avg_ai_score"), "student_id", "exam_id").limit(k)


def risk_level_distribution(kpis: DataFrame) -> DataFrame:
    """(student, exam) pairs per risk level."""
    return kpis.groupBy("risk_level").agg(F.count(F.lit(1)).alias("pairs"))

