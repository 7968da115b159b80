"""Registered queries: Structured Streaming.

Each runs a real streaming query over the driver's ``events`` table as a file
source (``availableNow``: drain and stop) and returns the sink's result; the
oracle is the batch formulation of the same rollup, so equality shows the
stream computes what the batch computes.
"""

from pyspark.sql import functions as F

from probity import schemas
from probity.operators import archive as A
from probity.plans.catalog import register
from probity.plans.q_collusion import _A20
from probity.plans.q_rollups import A9_DOUBLES, _A9
from probity.session import work_dir
from probity.streaming import ingest as I, windows as W

ATTEMPT_COLS = [f.name for f in schemas.EXAM_ATTEMPTS.fields]


def _stream(t):
    return I.attempts_stream(t.spark, t.sf_dir)


@register("stream_tumbling_5m", doubles=("avg_ai_score", "avg_response_time"), sql="""
SELECT time_bucket(INTERVAL 5 MINUTE, submission_timestamp) AS window_start, exam_id,
       avg(ai_usage_score) AS avg_ai_score, avg(response_time) AS avg_response_time,
       count(*) AS total_events
FROM exam_attempts GROUP BY 1, 2""")
def q_r6(t):
    return W.stream_tumbling(_stream(t), 5, by_exam=True)


@register("stream_tumbling_10m", doubles=("avg_ai_score", "avg_response_time"), sql="""
SELECT time_bucket(INTERVAL 10 MINUTE, submission_timestamp) AS window_start,
       avg(ai_usage_score) AS avg_ai_score, avg(response_time) AS avg_response_time,
       count(*) AS total_events
FROM exam_attempts GROUP BY 1""")
def q_r7(t):
    return W.stream_tumbling(_stream(t), 10, by_exam=False)


@register("stream_event_rate", sql="""
SELECT time_bucket(INTERVAL 1 MINUTE, submission_timestamp) AS window_start, count(*) AS events
FROM exam_attempts GROUP BY 1""")
def q_r9(t):
    return W.stream_event_rate(_stream(t))


@register("stream_high_risk", doubles=("ai_score",), sql="""
SELECT student_id, round(avg_ai, 3) AS ai_score, attempts FROM (
  SELECT student_id, avg(ai_usage_score) AS avg_ai, count(*) AS attempts
  FROM exam_attempts GROUP BY student_id HAVING avg(ai_usage_score) >= 0.7
  ORDER BY avg_ai DESC, student_id LIMIT 20) s""")
def q_r10(t):
    return W.stream_high_risk(_stream(t))


@register("stream_rolling_2h", doubles=A9_DOUBLES, sql=_A9)
def q_r8(t):
    return W.stream_rolling_kpis(_stream(t), "7 days", "1 hour")


@register("stream_rolling_2h_own", doubles=A9_DOUBLES, sql=_A9.replace("7 DAY", "2 HOUR"))
def q_r8_own(t):
    """R8 at the operator's own two hours, in micro-batches of two message files."""
    msgs = I.read_stream(t.spark, "text", _messages(t), max_per_trigger=2)
    out = W.stream_rolling_kpis(I.decode(msgs, schemas.ATTEMPT_MESSAGE, ["submission_timestamp"]))
    return out.withColumn("last_updated", F.col("last_updated").cast("timestamp_ntz"))


@register("stream_collusion", doubles=("avg_time_difference_seconds", "similarity_score"),
          sql=_A20.format(extra=""))
def q_r11(t):
    out = W.stream_collusion(_stream(t), "7 days", "1 hour")
    return out.withColumn("detected_at", F.col("detected_at").cast("timestamp_ntz"))


@register("stream_dedup", sql="SELECT attempt_id, submission_timestamp FROM exam_attempts")
def q_r2(t):
    table = W.ingest_table(_stream(t), "dedup")
    return t.spark.read.parquet(table).select("attempt_id", "submission_timestamp")


@register("publish_stream", sql="""
SELECT attempt_id AS key,
       CAST(to_json({'attempt_id': attempt_id, 'student_id': student_id, 'exam_id': exam_id,
                'answer_hash': answer_hash,
                'submission_timestamp': strftime(submission_timestamp, '%Y-%m-%dT%H:%M:%S.%f')})
         AS VARCHAR) AS value
FROM exam_attempts""")
def q_k9(t):
    a = t.attempts.select("attempt_id", "student_id", "exam_id", "answer_hash", "submission_timestamp")
    return I.encode(a, key="attempt_id", ts_fields=["submission_timestamp"]).select("key", "value")


@register("publish_and_read", doubles=("response_time", "ai_usage_score"), sql="SELECT * FROM exam_attempts")
def q_k9_sent(t):
    """K9 and back: the messages are sent to a topic of files and ingested from it."""
    topic = work_dir(t.spark, "topic")
    I.publish(t.attempts, topic, key="attempt_id", ts_fields=["submission_timestamp"])
    msgs = I.read_stream(t.spark, "parquet", topic, schema=I.MESSAGE, max_per_trigger=4)
    table = W.ingest_table(I.decode(msgs, schemas.ATTEMPT_MESSAGE, ["submission_timestamp"]).drop("key"), "sent")
    out = t.spark.read.parquet(table)
    return out.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c == "submission_timestamp"
                        else F.col(c) for c in ATTEMPT_COLS])


def _messages(t, rows=None, ts=("submission_timestamp",)):
    """K9 output written as JSON lines: one message per row, in eight files or
    more, so that a stream of two files per trigger takes several batches and
    sees event times out of order."""
    path = work_dir(t.spark, "messages")
    rows = t.attempts if rows is None else rows
    I.encode(rows, ts_fields=list(ts)).repartition(8, F.xxhash64("value")).write.text(path)
    return path


@register("decode_json", doubles=("response_time", "ai_usage_score"),
          sql="SELECT * FROM exam_attempts")
def q_s4(t):
    msgs = t.spark.read.text(_messages(t))
    d = I.decode(msgs, schemas.ATTEMPT_MESSAGE, ["submission_timestamp"])
    return d.filter("_valid").select(
        *[F.col(c).cast("timestamp_ntz").alias(c) if c == "submission_timestamp" else F.col(c)
          for c in ATTEMPT_COLS])


@register("stream_ingest", doubles=("response_time", "ai_usage_score"),
          sql="SELECT * FROM exam_attempts")
def q_r1(t):
    msgs = I.read_stream(t.spark, "text", _messages(t))
    table = W.ingest_table(I.decode(msgs, schemas.ATTEMPT_MESSAGE, ["submission_timestamp"]), "ingest")
    out = t.spark.read.parquet(table)
    return out.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c == "submission_timestamp"
                        else F.col(c) for c in ATTEMPT_COLS])


@register("stream_microbatch", doubles=("response_time", "ai_usage_score"),
          sql="SELECT * FROM exam_attempts")
def q_r3(t):
    """The same ingest in bounded micro-batches (2 message files per
    trigger): several upserts, each idempotent, same final table."""
    msgs = I.read_stream(t.spark, "text", _messages(t), max_per_trigger=2)
    d = I.decode(msgs, schemas.ATTEMPT_MESSAGE, ["submission_timestamp"])
    table = W.ingest_table(d, "microbatch")
    out = t.spark.read.parquet(table)
    return out.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c == "submission_timestamp"
                        else F.col(c) for c in ATTEMPT_COLS])


@register("stream_ingest_stats", sql="""
SELECT 2 * count(*) AS input_rows, count(*) AS inserted, count(*) AS duplicates FROM exam_attempts""")
def q_r5_stats(t):
    """Every message is published twice (two message folders); the
    counts are those the upserts stored."""
    base = work_dir(t.spark, "messages-twice")
    msgs = I.encode(t.attempts, ts_fields=["submission_timestamp"])
    msgs.write.text(f"{base}/copy=1")
    msgs.write.text(f"{base}/copy=2")
    src = I.read_stream(t.spark, "text", base, max_per_trigger=1).select("value")
    table = W.ingest_table(I.decode(src, schemas.ATTEMPT_MESSAGE, ["submission_timestamp"]), "stats")
    return I.ingest_stats(t.spark, table).agg(*[F.sum(c).alias(c) for c in ("input_rows", "inserted", "duplicates")])


@register("stream_progress", sql="""
SELECT 'progress' AS topic, count(*) AS input_rows, count(*) AS inserted, 0::BIGINT AS duplicates,
       0::BIGINT AS rejected, max(submission_timestamp) AS max_ts FROM exam_attempts""")
def q_r5(t):
    """Totals per topic over all micro-batches, however many."""
    table = W.ingest_table(_stream(t), "progress")
    sums = [F.sum(c).alias(c) for c in ("input_rows", "inserted", "duplicates", "rejected")]
    return I.ingest_stats(t.spark, table).groupBy("topic").agg(*sums, F.max("max_ts").cast("timestamp_ntz").alias("max_ts"))


@register("stream_ingest_sessions", doubles=("idle_time_seconds",), sql="SELECT * FROM session_logs")
def q_r1_sessions(t):
    """R1 for the second topic: session messages through the same path."""
    ts = ["session_start", "session_end"]
    msgs = I.read_stream(t.spark, "text", _messages(t, t.sessions, ts), max_per_trigger=2)
    table = W.ingest_table(I.decode(msgs, schemas.SESSION_MESSAGE, ts), "sessions", key="log_id", ts="session_start")
    out = t.spark.read.parquet(table)
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.SESSION_LOGS.fields])


@register("stream_rejects", sql="""
SELECT 'malformed message' AS reason, count(*) AS messages FROM exam_attempts
WHERE CAST(regexp_extract(attempt_id, '[0-9]+') AS BIGINT) % 10 = 3
HAVING count(*) > 0""")
def q_r1_rejects(t):
    """Rejected messages are stored with their reason: here every message whose
    attempt number ends in 3 is cut short on its way."""
    number = F.regexp_extract("attempt_id", "[0-9]+", 0).cast("long")
    ids = F.get_json_object("value", "$.attempt_id")
    whole = I.encode(t.attempts, ts_fields=["submission_timestamp"]).withColumn("attempt_id", ids)
    path = work_dir(t.spark, "messages-cut")
    cut = F.when(number % 10 == 3, F.expr("substring(value, 1, length(value) - 2)")).otherwise(F.col("value"))
    whole.select(cut.alias("value")).repartition(8, F.xxhash64("value")).write.text(path)
    msgs = I.read_stream(t.spark, "text", path, max_per_trigger=2)
    table = W.ingest_table(I.decode(msgs, schemas.ATTEMPT_MESSAGE, ["submission_timestamp"]), "rejects")
    return t.spark.read.parquet(f"{table}_rejects").groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))


@register("stream_archive", doubles=("pct",), sql="""
, arc AS (SELECT * FROM exam_attempts
          WHERE submission_timestamp < (SELECT t FROM as_of) - INTERVAL 48 HOUR),
ses AS (SELECT * FROM session_logs WHERE session_start < (SELECT t FROM as_of) - INTERVAL 48 HOUR)
SELECT 'exam_attempts' AS "table", (SELECT count(*) FROM arc) AS n_hot, (SELECT count(*) FROM arc) AS n_archived,
       0.0::DOUBLE AS pct, true AS ok
UNION ALL
SELECT 'session_logs', (SELECT count(*) FROM ses), (SELECT count(*) FROM ses), 0.0::DOUBLE, true""")
def q_r12(t):
    out = []
    for table, df, ts, key in (("exam_attempts", t.attempts, "submission_timestamp", "attempt_id"),
                               ("session_logs", t.sessions, "session_start", "log_id")):
        res = A.run_archival(t.spark, df, ts, key, work_dir(t.spark, "arch"), work_dir(t.spark, "staging"), t.as_of,
                             table=table, hot_path=work_dir(t.spark, "hot"), log_path=work_dir(t.spark, "log"))
        out.append(res["reconcile"])
    return out[0].unionByName(out[1])
