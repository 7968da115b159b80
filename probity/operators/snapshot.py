"""K5-K7: KPI snapshot with expiry (the effect of a key/value cache with TTL),
as a table of ``(key, value_json, written_at, expires_at)``.

One naming scheme for keys: ``kpi:<name>[:<scope>]`` (quirk Q23).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from probity.functions.timecols import as_column
from probity.operators.publish import Published
from probity.operators import collusion, rollups
from probity.session import materialize

SNAPSHOT_COLS = ["key", "value_json", "written_at", "expires_at"]


def entries(df: DataFrame, key: Column, value: Column, as_of, ttl_seconds: int = 60) -> DataFrame:
    """Rows of one KPI frame as snapshot entries."""
    t = as_column(as_of)
    return df.select(key.alias("key"), F.to_json(value).alias("value_json"),
                     t.alias("written_at"),
                     (t + F.make_dt_interval(secs=F.lit(ttl_seconds))).alias("expires_at"))


def kpi_snapshot(attempts: DataFrame, as_of, ttl_seconds: int = 60,
                 lookback: str | None = "2 hours") -> DataFrame:
    """K5: the cached KPI set -- overall and per-exam average response time,
    accuracy, AI usage buckets, top-20 high-risk students, collusion cases.

    List-valued entries are built from top-k frames (<= 20 / 50 rows).  The rows
    of the look-back window are written once with the columns that the entries
    read, so the fact table is scanned once."""
    a = attempts
    if lookback is not None:
        a = a.filter(F.col("submission_timestamp") >= as_column(as_of) - F.expr(f"INTERVAL {lookback}"))
    a = materialize(a.select("attempt_id", "student_id", "exam_id", "question_id", "answer_hash", "response_time",
                             "is_correct", "ai_usage_score"), "snapshot-window")
    parts = [
        entries(rollups.avg_response_time_all(a), F.lit("kpi:avg_response_time:all"),
                F.struct("value"), as_of, ttl_seconds),
        entries(rollups.avg_response_time_by_exam(a),
                F.concat(F.lit("kpi:avg_response_time:exam:"), F.col("exam_id")),
                F.struct("value"), as_of, ttl_seconds),
        entries(rollups.accuracy_rate_all(a), F.lit("kpi:accuracy_rate:all"),
                F.struct("value"), as_of, ttl_seconds),
        entries(rollups.ai_usage_buckets(a), F.concat(F.lit("kpi:ai_usage:"), F.col("label")),
                F.struct("count"), as_of, ttl_seconds),
    ]
    top = rollups.high_risk_students_top(a, 20)
    # sorted by score descending, then id: sort on the negated score first
    students = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("ai_score")).alias("neg"),
                                                            "student_id", "ai_score"))).alias("s"),
                       F.count(F.lit(1)).alias("count"))
    students = students.select(
        F.transform("s", lambda x: F.struct(x["student_id"].alias("student_id"),
                                            x["ai_score"].alias("ai_score"))).alias("students"),
        "count")
    parts.append(entries(students, F.lit("kpi:high_risk_students"),
                         F.struct("students", "count"), as_of, ttl_seconds))
    cases = collusion.collusion_cases(a, None, None)
    c = cases.agg(F.array_sort(F.collect_list(F.struct("exam_id", "question_id", "students", "count")))
                  .alias("cases"), F.count(F.lit(1)).alias("total"))
    parts.append(entries(c, F.lit("kpi:collusion_cases"), F.struct("cases", "total"),
                         as_of, ttl_seconds))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_snapshot(snapshot: DataFrame, path: str) -> DataFrame:
    """K5: publish ``snapshot`` as a new version at ``path`` and return a reader on it.

    The entries are a bounded table (one per exam and a few more), so one file."""
    version = Published(snapshot.sparkSession, path).publish(snapshot.coalesce(1))
    return snapshot.sparkSession.read.schema(snapshot.schema).parquet(version)


def stored_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The current version of the snapshot at ``path``."""
    return Published(spark, path).read()


def read_snapshot(snapshot: DataFrame, as_of, keys: list[str] | None = None,
                  recompute: DataFrame | None = None) -> DataFrame:
    """K6: entries that have not expired at ``as_of``.  With ``recompute``
    (fresh entries in snapshot form) missing or expired keys are filled from
    it -- cache-aside written as one plan (anti-join + union)."""
    s = snapshot.filter(F.col("expires_at") > as_column(as_of))
    if keys is not None:
        s = s.filter(F.col("key").isin(keys))
    if recompute is None:
        return s
    r = recompute if keys is None else recompute.filter(F.col("key").isin(keys))
    return s.unionByName(r.join(s.select("key"), "key", "left_anti").select(*SNAPSHOT_COLS))


def freshness(snapshot: DataFrame, as_of, evict_below: int = 10, fresh_above: int = 30) -> DataFrame:
    """K7: seconds to expiry per key and its state: ``evict`` (0 < ttl <
    10 s), ``fresh`` (ttl > 30 s), ``expired`` (ttl <= 0) or ``stale``."""
    ttl = F.timestamp_diff("MICROSECOND", as_column(as_of), F.col("expires_at")) / 1e6
    return snapshot.select("key", ttl.alias("ttl_seconds")).withColumn(
        "state", F.when(F.col("ttl_seconds") <= 0, "expired")
        .when(F.col("ttl_seconds") < evict_below, "evict")
        .when(F.col("ttl_seconds") > fresh_above, "fresh").otherwise("stale"))


def freshness_health(snapshot: DataFrame, as_of, tracked: list[str]) -> DataFrame:
    """K7 health: fresh tracked keys out of the tracked set (n / 3)."""
    f = freshness(snapshot, as_of).filter(F.col("key").isin(tracked))
    return f.agg(F.count(F.when(F.col("state") == "fresh", 1)).alias("fresh")).select(
        "fresh", F.lit(len(tracked)).alias("tracked"),
        (F.col("fresh") / F.lit(len(tracked))).alias("health"))
