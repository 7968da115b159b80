"""Streaming: JSON decode with quarantine, idempotent upsert, dedup and late
data against the watermark."""

import datetime as dt
import json

from pyspark.sql import functions as F

from probity import schemas
from probity.session import work_dir
from probity.streaming import ingest as I, windows as W


def test_decode_quarantines_bad_messages(spark):
    msgs = [json.dumps({"attempt_id": "A1", "submission_timestamp": "2024-01-01T10:00:00Z"}),
            "{not json",
            json.dumps({"attempt_id": "A3", "submission_timestamp": "yesterday"}),
            json.dumps({"attempt_id": "A4", "submission_timestamp": "2024-01-01T10:00:00.5+01:00"})]
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    out = {r.attempt_id: r for r in I.decode(df, schemas.ATTEMPT_MESSAGE, ["submission_timestamp"]).collect()}
    assert out["A1"]._valid and out["A4"]._valid
    assert not out["A3"]._valid
    assert out[None]._corrupt_record == "{not json"
    assert out["A4"].submission_timestamp == dt.datetime(2024, 1, 1, 9, 0, 0, 500000)


def test_upsert_skips_duplicates_within_and_across_batches(spark):
    target = work_dir(spark, "upsert-test")
    t = dt.datetime(2024, 1, 1, 10)
    b1 = spark.createDataFrame([("A1", t), ("A1", t), ("A2", t)], "attempt_id string, submission_timestamp timestamp_ntz")
    b2 = spark.createDataFrame([("A2", t), ("A3", t)], "attempt_id string, submission_timestamp timestamp_ntz")
    r1 = I.upsert(b1, target, "attempt_id", ts="submission_timestamp", batch_id=0)
    r2 = I.upsert(b2, target, "attempt_id", ts="submission_timestamp", batch_id=1)
    again = I.upsert(b2, target, "attempt_id", ts="submission_timestamp", batch_id=2)   # sent again
    I.upsert(b2, target, "attempt_id", ts="submission_timestamp", batch_id=1)           # replayed batch
    assert (r1["rows"], r1["inserted"], r1["duplicates"]) == (3, 2, 1)
    assert (r2["inserted"], r2["duplicates"]) == (1, 1)
    assert again["inserted"] == 0
    ids = sorted(r.attempt_id for r in spark.read.parquet(target).collect())
    assert ids == ["A1", "A2", "A3"]


def test_late_event_beyond_watermark_is_dropped(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    base = dt.datetime(2024, 1, 1, 12, 0)
    # batch 1 moves the watermark to 12:00 + 3h - 2h = 13:00
    (src / "b1.json").write_text("\n".join(json.dumps(r) for r in [
        {"attempt_id": "A1", "exam_id": "E", "ai_usage_score": 0.5, "response_time": 1.0,
         "submission_timestamp": (base + dt.timedelta(hours=3)).isoformat()}]))
    schema = "attempt_id string, exam_id string, ai_usage_score double, response_time double, submission_timestamp timestamp"
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(src))
              .withColumn("event_ts", F.col("submission_timestamp")))
    sink = work_dir(spark, "late-sink")
    agg = W.tumbling(I.dedup(stream, "attempt_id"), 5, ["exam_id"],
                     [F.count(F.lit(1)).alias("total_events")])
    ckpt = work_dir(spark, "late-ckpt")
    q1 = (agg.writeStream.outputMode("update").foreachBatch(W._append_with_batch(sink))
          .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q1.awaitTermination()
    # batch 2: one on-time event, one older than the watermark
    (src / "b2.json").write_text("\n".join(json.dumps(r) for r in [
        {"attempt_id": "A2", "exam_id": "E", "ai_usage_score": 0.5, "response_time": 1.0,
         "submission_timestamp": (base + dt.timedelta(hours=3, minutes=1)).isoformat()},
        {"attempt_id": "A3", "exam_id": "E", "ai_usage_score": 0.5, "response_time": 1.0,
         "submission_timestamp": base.isoformat()}]))
    q2 = (agg.writeStream.outputMode("update").foreachBatch(W._append_with_batch(sink))
          .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q2.awaitTermination()
    res = {(r.window_start, r.total_events) for r in W.latest(spark, sink, ["window_start", "exam_id"]).collect()}
    assert res == {(dt.datetime(2024, 1, 1, 15, 0), 2)}


def test_sink_compaction_keeps_latest_and_drops_superseded_rows(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    base = dt.datetime(2024, 1, 1, 12, 0)
    # four files -> four micro-batches; the same 5-minute window is updated each time
    for i in range(4):
        (src / f"b{i}.json").write_text(json.dumps(
            {"attempt_id": f"A{i}", "exam_id": "E", "ai_usage_score": 0.5, "response_time": 1.0,
             "submission_timestamp": (base + dt.timedelta(minutes=i % 2)).isoformat()}))
    schema = ("attempt_id string, exam_id string, ai_usage_score double, response_time double, "
              "submission_timestamp timestamp")
    results = {}
    for every in (None, 1):
        stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(src))
                  .withColumn("event_ts", F.col("submission_timestamp")))
        agg = W.tumbling(I.dedup(stream, "attempt_id"), 5, ["exam_id"],
                         [F.count(F.lit(1)).alias("total_events")])
        sink = work_dir(spark, "compact-sink")
        keys = ["window_start", "exam_id"]
        I.run_available_now(agg, W._append_with_batch(sink, keys, every), f"compact{every}",
                            output_mode="update")
        results[every] = ([tuple(r) for r in W.latest(spark, sink, keys).collect()],
                          spark.read.parquet(sink).count())
    assert results[None][0] == results[1][0] == [(dt.datetime(2024, 1, 1, 12, 0), "E", 4)]
    assert results[None][1] == 4          # one updated row per batch, all kept
    assert results[1][1] == 1             # compaction keeps only the current row


def test_state_based_high_risk_equals_batch(spark):
    from conftest import SF_SMALL
    from probity.operators import rollups
    from probity.sources.tables import Tables
    got = W.stream_high_risk_state(I.attempts_stream(spark, SF_SMALL)).collect()
    want = rollups.high_risk_students_top(Tables(spark, SF_SMALL).attempts, 20).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_late_rows_and_keys_of_other_days_survive_many_batches(spark, tmp_path):
    """Eight files in shuffled time order, one per trigger: every row is kept, in
    the table and in the windows; a key repeated on another day stays single."""
    base = dt.datetime(2024, 1, 1)
    src = tmp_path / "src"
    src.mkdir()
    order = [5, 0, 7, 2, 6, 1, 4, 3]
    for k, day in enumerate(order):
        rows = [{"attempt_id": f"A{day}-{i}", "exam_id": "E", "student_id": "S", "ai_usage_score": 0.5,
                 "response_time": 1.0, "submission_timestamp": (base + dt.timedelta(days=day, minutes=i)).isoformat()}
                for i in range(5)]
        rows.append(dict(rows[0], attempt_id="SAME"))
        f = src / f"f{k}.json"
        f.write_text("\n".join(json.dumps(r) for r in rows))
        import os
        os.utime(f, (1_700_000_000 + k, 1_700_000_000 + k))
    schema = ("attempt_id string, exam_id string, student_id string, ai_usage_score double, response_time double, "
              "submission_timestamp timestamp")

    def stream():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(src))

    table = W.ingest_table(stream(), "late")
    ids = [r.attempt_id for r in spark.read.parquet(table).collect()]
    assert len(ids) == 41 and len(set(ids)) == 41
    stats = I.ingest_stats(spark, table).collect()
    assert len(stats) == 8
    assert sum(r.input_rows for r in stats) == 48 and sum(r.duplicates for r in stats) == 7
    assert max(r.max_ts for r in stats).date() == dt.date(2024, 1, 8)
    windows = W.stream_tumbling(stream(), 5).collect()
    assert sum(r.total_events for r in windows) == 41


def test_replayed_batch_keeps_its_partial_sums(spark):
    target = work_dir(spark, "replay-test")
    t = dt.datetime(2024, 1, 1, 10)
    b = spark.createDataFrame([("A1", t), ("A2", t)], "attempt_id string, submission_timestamp timestamp_ntz")
    seen = []
    for _ in range(2):
        I.upsert(b, target, "attempt_id", ts="submission_timestamp", batch_id=7,
                 on_new=lambda rows: seen.append(sorted(r.attempt_id for r in rows.collect())))
    assert seen == [["A1", "A2"], ["A1", "A2"]]
    assert spark.read.parquet(target).count() == 2


def test_means_do_not_depend_on_the_file_layout(spark, tmp_path):
    from conftest import SF_SMALL
    from probity.operators import kpis, rollups
    from probity.sources.tables import Tables
    whole = Tables(spark, SF_SMALL).attempts
    whole.repartition(8).write.parquet(str(tmp_path / "parts"))
    parts = spark.read.parquet(str(tmp_path / "parts"))
    for f in (kpis.kpi_ai_usage, rollups.avg_response_time_by_exam):
        assert sorted(map(tuple, f(whole).collect())) == sorted(map(tuple, f(parts).collect()))
