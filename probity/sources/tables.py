"""S1 ``scan_table`` and the adapters that present the driver's tables as the
exam schema (students, courses, exams, questions, exam_attempts,
session_logs, answers).

Adapters are pure projections/aggregations over the source tables, so Catalyst
prunes columns down to the Parquet scan and pushes filters through them.
``exam_attempts`` is one row per event (a projection, no shuffle);
``session_logs`` is one grouped aggregate.  Dimension tables derived from a
handful of distinct values are left for AQE to broadcast from runtime sizes.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from probity import schemas


def read_table(spark: SparkSession, sf_dir: str, name: str, fmt: str = "parquet",
               options: dict | None = None) -> DataFrame:
    """Batch-load one table with its declared schema (no inference).

    ``fmt`` may name any batch source (e.g. a document-store connector when
    its package is on the classpath); ``options`` are passed through.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    schema = schemas.SOURCE_SCHEMAS.get(name) or schemas.TABLE_SCHEMAS.get(name)
    if schema is not None and fmt == "parquet":
        reader = reader.schema(schema)
    path = f"{sf_dir.rstrip('/')}/{name}.parquet" if fmt == "parquet" else None
    return reader.load(path) if path else reader.load()


def scan_limit(df: DataFrame, n: int = 100, order_by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows.  Unordered it is a peek (``CollectLimit``
    reads only as many splits as it needs); with ``order_by`` it is a
    deterministic top-n (per-task top-n, then a merge of n rows per task)."""
    return df.orderBy(*order_by).limit(n) if order_by else df.limit(n)


def zero_pad_id(prefix: str, c: Column | str, width: int) -> Column:
    """``prefix`` + zero-padded integer id (e.g. ``ATT000000042``)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lit(prefix), F.lpad(col.cast("string"), width, "0"))


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("bigint")


def attempts_from_events(events: DataFrame) -> DataFrame:
    """exam_attempts: one row per event (FIXTURES.md section 3)."""
    k = _k(F.col("props"))
    eid, uid, et = F.col("event_id"), F.col("user_id"), F.col("event_type")
    bucket = F.pmod(uid, F.lit(20))
    base = F.when(bucket < 15, F.lit(0.0)).when(bucket < 18, F.lit(0.75)).otherwise(F.lit(0.3))
    span = F.when(bucket < 15, F.lit(0.3)).when(bucket < 18, F.lit(0.23)).otherwise(F.lit(0.3))
    frac = F.pmod(eid * 7919, F.lit(1000)).cast("double") / F.lit(1000.0)
    is_correct = F.pmod(eid * 31 + k, F.lit(10)) < 7
    answer_text = F.concat(et, F.lit(" "), k.cast("string"))
    return events.select(
        zero_pad_id("ATT", eid, 9).alias("attempt_id"),
        zero_pad_id("STU", uid, 6).alias("student_id"),
        F.concat(F.lit("EXM_"), et).alias("exam_id"),
        F.concat(F.lit("QST_"), et, F.lit("_"), F.pmod(k, F.lit(10)).cast("string")).alias("question_id"),
        F.col("value").alias("response_time"),
        is_correct.alias("is_correct"),
        (base + span * frac).alias("ai_usage_score"),
        F.pmod(eid * 13, F.lit(500)).cast("int").alias("keystroke_count"),
        F.pmod(k, F.lit(4)).cast("int").alias("paste_count"),
        F.sha2(answer_text, 256).alias("answer_hash"),
        answer_text.alias("answer_text"),
        F.col("ts").alias("submission_timestamp"),
        F.when(is_correct, F.lit(10)).otherwise(F.pmod(eid, F.lit(10))).cast("int").alias("marks_obtained"),
        bucket.between(15, 17).alias("flagged"),
    )


# Device and browser by user_id modulo 4 and 5.
DEVICES = ["Desktop", "Laptop", "Tablet", "Mobile"]
BROWSERS = ["Chrome", "Firefox", "Safari", "Edge", "Opera"]


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def sessions_from_events(events: DataFrame) -> DataFrame:
    """session_logs: one row per (user, event_type, week of ts)."""
    k = _k(F.col("props"))
    uid = F.col("user_id")
    g = (events
         .groupBy("user_id", "event_type", F.date_trunc("week", "ts").alias("week"))
         .agg(F.min("event_id").alias("min_eid"),
              F.sum(F.pmod(k, F.lit(7))).alias("tabs"),
              F.sum(F.pmod(k, F.lit(5))).alias("focus"),
              F.sum(F.pmod(k, F.lit(3))).alias("copies"),
              F.count(F.when(k == 0, 1)).alias("shots"),
              F.max(k).alias("max_k"),
              # exact decimal sum: order-independent, so any partitioning
              # (or a retried task) yields the same double
              F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("idle"),
              F.min("ts").alias("start"),
              F.max("ts").alias("end")))
    return g.select(
        zero_pad_id("LOG", F.col("min_eid"), 9).alias("log_id"),
        zero_pad_id("STU", uid, 6).alias("student_id"),
        F.concat(F.lit("EXM_"), F.col("event_type")).alias("exam_id"),
        F.col("tabs").cast("int").alias("tab_switches"),
        F.col("idle").alias("idle_time_seconds"),
        F.col("focus").cast("int").alias("focus_loss_count"),
        F.col("copies").cast("int").alias("copy_count"),
        F.col("shots").cast("int").alias("screenshot_attempts"),
        _pick(DEVICES, F.pmod(uid, F.lit(4))).alias("device_type"),
        _pick(BROWSERS, F.pmod(uid, F.lit(5))).alias("browser"),
        F.concat(F.lit("10.0."), F.floor(uid / 250).cast("string"), F.lit("."),
                 F.pmod(uid, F.lit(250)).cast("string")).alias("ip_address"),
        F.col("start").alias("session_start"),
        F.col("end").alias("session_end"),
        F.pmod(F.col("max_k"), F.lit(3)).cast("int").alias("warnings_issued"),
    )


def students_from_customers(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """students: customer joined to nation and region.

    nation (25 rows) and region (5 rows) are fixed-size reference tables, so
    broadcasting them is bounded regardless of scale factor.
    """
    geo = F.broadcast(nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
                      .select("n_nationkey", "r_name"))
    c = customer.join(geo, customer.c_nationkey == geo.n_nationkey, "left")
    key = F.col("c_custkey")
    return c.select(
        zero_pad_id("STU", key, 6).alias("student_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))),
                 F.lit("@university.edu")).alias("email"),
        F.col("c_mktsegment").alias("program"),
        (F.pmod(key, F.lit(5)) + 1).cast("int").alias("academic_year"),
        F.col("r_name").alias("region"),
        F.round((F.col("c_acctbal") + 1000) / 11000, 2).alias("skill_level"),
        (F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(F.pmod(key, F.lit(1461)).cast("int"))).alias("enrollment_date"),
    )


# Exam type, department and difficulty per event type.
EXAM_TYPES = {"click": "midterm", "error": "midterm", "view": "final",
              "purchase": "quiz", "signup": "assignment"}
DEPARTMENTS = {"click": "Computer Science", "error": "Engineering", "purchase": "Business",
               "signup": "Mathematics", "view": "Physics"}
DIFFICULTY = {"click": 2, "error": 4, "purchase": 3, "signup": 1, "view": 5}
QUESTION_TYPES = ["MCQ", "short-answer", "essay", "coding", "true-false"]


def _case(c: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v)))
    return out.otherwise(F.lit(default))


def exams_from_events(events: DataFrame) -> DataFrame:
    et = F.col("event_type")
    return events.select("event_type").distinct().select(
        F.concat(F.lit("EXM_"), et).alias("exam_id"),
        F.concat(F.lit("CRS_"), et).alias("course_id"),
        F.concat(et, F.lit(" exam")).alias("exam_name"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("exam_date"),
        F.lit(120).alias("duration_minutes"),
        F.lit(100).alias("total_marks"),
        _case(et, EXAM_TYPES).alias("exam_type"),
        (et != "error").alias("proctored"),
    )


def courses_from_events(events: DataFrame) -> DataFrame:
    et = F.col("event_type")
    return events.select("event_type").distinct().select(
        F.concat(F.lit("CRS_"), et).alias("course_id"),
        F.concat(et, F.lit(" course")).alias("course_name"),
        F.concat(F.lit("INS_"), et).alias("instructor_id"),
        F.concat(F.lit("Instructor "), et).alias("instructor_name"),
        _case(et, DIFFICULTY).cast("int").alias("difficulty_level"),
        _case(et, DEPARTMENTS).alias("department"),
        F.lit(3).alias("credits"),
    )


def questions_from_events(events: DataFrame) -> DataFrame:
    q = F.pmod(_k(F.col("props")), F.lit(10))
    d = events.select("event_type", q.alias("q")).distinct()
    et = F.col("event_type")
    return d.select(
        F.concat(F.lit("QST_"), et, F.lit("_"), F.col("q").cast("string")).alias("question_id"),
        F.concat(F.lit("EXM_"), et).alias("exam_id"),
        (F.col("q") + 1).cast("int").alias("question_number"),
        (F.pmod(F.col("q"), F.lit(5)) + 1).cast("int").alias("difficulty_level"),
        _pick(QUESTION_TYPES, F.pmod(F.col("q"), F.lit(5))).alias("question_type"),
        F.lit(10).alias("max_marks"),
        F.lit(90).alias("expected_time_seconds"),
        et.alias("topic"),
    )


def answers_from_documents(documents: DataFrame) -> DataFrame:
    """Answer texts for the text operators: one per document."""
    return documents.select(
        F.col("doc_id").alias("student_id"),
        F.col("lang").alias("question_id"),
        F.col("source").alias("exam_id"),
        F.col("text").alias("answer_text"),
    )


class Tables:
    """Lazily built exam tables over one driver data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @cached_property
    def events(self) -> DataFrame:
        return self.raw("events")

    @cached_property
    def attempts(self) -> DataFrame:
        return attempts_from_events(self.events)

    @cached_property
    def sessions(self) -> DataFrame:
        return sessions_from_events(self.events)

    @cached_property
    def students(self) -> DataFrame:
        return students_from_customers(self.raw("customer"), self.raw("nation"), self.raw("region"))

    @cached_property
    def exams(self) -> DataFrame:
        return exams_from_events(self.events)

    @cached_property
    def courses(self) -> DataFrame:
        return courses_from_events(self.events)

    @cached_property
    def questions(self) -> DataFrame:
        return questions_from_events(self.events)

    @cached_property
    def answers(self) -> DataFrame:
        return answers_from_documents(self.raw("documents"))

    @cached_property
    def as_of(self) -> Column:
        """Fixture "now": the newest submission time, as a scalar subquery."""
        return self.events.select(F.max("ts")).scalar()
