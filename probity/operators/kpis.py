"""The seven per-(student, exam) KPIs of the batch KPI job.

A1-A4 share one grouping, so ``pair_kpis`` computes them in a single
aggregate (one shuffle, partial aggregation map-side); the single-KPI
functions project from it.  The scalar maximum of J6 is a scalar subquery,
planned as a separate small job whose value is inlined -- no cross join and
no driver round trip inside the operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probity.functions.exact import mean
from probity.functions.bands import suspicion_band

PAIR = ["student_id", "exam_id"]


def accuracy_expr():
    """Percent correct; a null ``is_correct`` counts as wrong."""
    return (F.sum(F.when(F.col("is_correct"), 1).otherwise(0)) / F.count(F.lit(1)) * 100)


def pair_kpis(attempts: DataFrame) -> DataFrame:
    """A1-A4 fused: avg response time, accuracy, sample stddev, avg AI score."""
    return attempts.groupBy(*PAIR).agg(
        mean("response_time").alias("avg_response_time"),
        accuracy_expr().alias("accuracy_rate"),
        F.stddev_samp("response_time").alias("response_variance"),
        mean("ai_usage_score").alias("avg_ai_usage_score"),
    )


def kpi_avg_response_time(attempts: DataFrame) -> DataFrame:
    """A1."""
    return attempts.groupBy(*PAIR).agg(mean("response_time").alias("avg_response_time"))


def kpi_accuracy_rate(attempts: DataFrame) -> DataFrame:
    """A2."""
    return attempts.groupBy(*PAIR).agg(accuracy_expr().alias("accuracy_rate"))


def kpi_response_variance(attempts: DataFrame) -> DataFrame:
    """A3: *sample* standard deviation (NULL for one-attempt pairs)."""
    return attempts.groupBy(*PAIR).agg(F.stddev_samp("response_time").alias("response_variance"))


def kpi_ai_usage(attempts: DataFrame) -> DataFrame:
    """A4."""
    return attempts.groupBy(*PAIR).agg(mean("ai_usage_score").alias("avg_ai_usage_score"))


def kpi_session_irregularity(sessions: DataFrame, clip: bool = False) -> DataFrame:
    """One row per session log: tabs*0.3 + focus*0.4 + idle/7200*0.3.

    Unbounded as specified (quirk Q8); ``clip=True`` adds the [0, 1] clipped
    value documented for the KPI.
    """
    score = (F.col("tab_switches") * 0.3 + F.col("focus_loss_count") * 0.4
             + (F.col("idle_time_seconds") / 7200) * 0.3)
    out = sessions.select(*PAIR, score.alias("irregularity_score"))
    if clip:
        out = out.withColumn("irregularity_clipped", F.least(F.col("irregularity_score"), F.lit(1.0)))
    return out


def kpi_left_join(ai: DataFrame, variance: DataFrame, irregularity: DataFrame) -> DataFrame:
    """Left-join the three KPI frames on (student, exam), numeric nulls -> 0.

    Several sessions per pair fan out (quirk Q4); NaN is also replaced.
    """
    return (ai.join(variance, PAIR, "left").join(irregularity, PAIR, "left").fillna(0))


def scalar_max(df: DataFrame, column: str):
    """The global maximum of ``column`` as a scalar-subquery Column."""
    return df.select(F.max(column)).scalar()


def kpi_suspicion(attempts: DataFrame, sessions: DataFrame, dedup_sessions: bool = False) -> DataFrame:
    """0.4*ai + 0.3*(1 - var/max_var) + 0.3*irregularity.

    ``max_var`` is the maximum over the joined frame; null or 0 become 100
    (quirk Q3).  ``dedup_sessions=True`` is ``kpi_suspicion_dedup``: the
    maximum irregularity per pair instead of one row per session.
    """
    k = pair_kpis(attempts).select(*PAIR, "response_variance", "avg_ai_usage_score")
    irr = kpi_session_irregularity(sessions)
    if dedup_sessions:
        irr = irr.groupBy(*PAIR).agg(F.max("irregularity_score").alias("irregularity_score"))
    # The AI and variance KPIs share their key set, so J5's first join is the
    # fused aggregate itself; only the session side needs a join.
    joined = k.join(irr, PAIR, "left").fillna(0)
    # The left join only repeats pair rows, so the maximum over the joined,
    # zero-filled frame is the maximum of coalesce(variance, 0) over the pair
    # aggregate itself -- no need to evaluate the join twice.
    max_var = F.coalesce(F.nullif(
        k.select(F.coalesce("response_variance", F.lit(0.0)).alias("v")).select(F.max("v")).scalar(),
        F.lit(0.0)), F.lit(100.0))
    score = (F.col("avg_ai_usage_score") * 0.4
             + (1 - F.col("response_variance") / max_var) * 0.3
             + F.col("irregularity_score") * 0.3)
    return joined.select(*PAIR, score.alias("suspicion_score"))


def kpi_suspicion_banded(attempts: DataFrame, sessions: DataFrame) -> DataFrame:
    """A7 with the C6 colour band."""
    s = kpi_suspicion(attempts, sessions)
    return s.withColumn("suspicion_band", suspicion_band("suspicion_score"))


def kpi_counts(attempts: DataFrame, sessions: DataFrame) -> DataFrame:
    """(kpi, records) of the six KPI frames.

    The four KPIs of one aggregate share its rows, so they share one count."""
    shared = ["avg_response_time", "accuracy_rate", "response_variance", "ai_usage_score"]
    n = F.count(F.lit(1)).alias("records")
    pairs = attempts.select(*PAIR).distinct().agg(n).select(
        F.explode(F.array(*[F.lit(k) for k in shared])).alias("kpi"), "records")
    for name, df in (("session_irregularity_score", kpi_session_irregularity(sessions)),
                     ("suspicion_confidence", kpi_suspicion(attempts, sessions))):
        pairs = pairs.unionByName(df.agg(n).select(F.lit(name).alias("kpi"), "records"))
    return pairs
