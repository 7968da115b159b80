"""Archive and snapshot behaviour on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from probity import schemas
from probity.operators import archive as A, snapshot as S
from probity.session import work_dir

T = dt.datetime(2024, 1, 10, 12)


def _attempts(spark, days):
    rows = [(f"A{i}", "S", "E", "Q", 1.0, True, 0.5, 1, 0, "h" * 64, "x", T - dt.timedelta(days=d), 1, False)
            for i, d in enumerate(days)]
    return spark.createDataFrame(rows, schemas.EXAM_ATTEMPTS)


def test_missing_archive_is_empty_with_schema(spark):
    df = A.read_archive(spark, work_dir(spark, "nothing-here"), schemas.EXAM_ATTEMPTS)
    assert df.count() == 0 and df.columns[-3:] == ["year", "month", "day"]


def test_archive_restore_reconcile(spark):
    hot = _attempts(spark, [0, 1, 3, 4, 5])
    path = work_dir(spark, "arch")
    old = A.eligible(hot, "submission_timestamp", T)          # older than 48 h: days 3, 4, 5
    A.write_archive(old, "submission_timestamp", path)
    arc = A.read_archive(spark, path, schemas.EXAM_ATTEMPTS)
    assert sorted(r.day for r in A.archive_partitions(arc).collect()) == [5, 6, 7]
    kept = A.retain_hot(hot, arc, "attempt_id")
    assert sorted(r.attempt_id for r in kept.collect()) == ["A0", "A1"]
    rec = A.reconcile(old, arc, "t").first()
    assert (rec.n_hot, rec.n_archived, rec.ok) == (3, 3, True)
    back = A.restore(arc, kept, "attempt_id", dt.date(2024, 1, 6), dt.date(2024, 1, 7))
    assert sorted(r.attempt_id for r in back.collect()) == ["A0", "A1", "A2", "A3"]
    m = A.manifest(arc, path).first()
    assert m.record_count == 3 and list(m.partitions)[0] == "year=2024/month=1/day=5"


def test_snapshot_expiry_and_cache_aside(spark):
    snap = S.kpi_snapshot(_attempts(spark, [0, 0]), T, ttl_seconds=60, lookback="1 day")
    assert S.read_snapshot(snap, T + dt.timedelta(seconds=59)).count() == snap.count()
    assert S.read_snapshot(snap, T + dt.timedelta(seconds=60)).count() == 0
    fresh = S.kpi_snapshot(_attempts(spark, [0]), T + dt.timedelta(seconds=61), 60, "1 day")
    filled = S.read_snapshot(snap, T + dt.timedelta(seconds=61), keys=["kpi:avg_response_time:all"],
                             recompute=fresh).collect()
    assert len(filled) == 1 and filled[0].written_at == T + dt.timedelta(seconds=61)
    states = {r.state for r in S.freshness(snap, T + dt.timedelta(seconds=55)).collect()}
    assert states == {"evict"}


def test_archival_job_retry_and_mismatch(spark, monkeypatch):
    hot = _attempts(spark, [0, 1, 3, 4, 5])
    where = {n: work_dir(spark, n) for n in ("arch", "staging", "hot", "log")}

    def job(rows, run_id):
        return A.run_archival(spark, rows, "submission_timestamp", "attempt_id", where["arch"], where["staging"], T,
                              run_id=run_id, hot_path=where["hot"], log_path=where["log"])

    first = job(hot, "r1")
    again = job(hot, "r1")                                    # a retry appends nothing twice
    for res in (first, again):
        assert res["reconcile"].first().n_archived == 3
        assert sorted(r.attempt_id for r in res["hot"].collect()) == ["A0", "A1"]
    assert A.read_archive(spark, where["arch"], schemas.EXAM_ATTEMPTS).count() == 3
    log = again["log"].collect()
    assert [(r.status, r.rows_archived, r.remaining_rows) for r in log] == [("SUCCESS", 3, 2)] * 2
    assert all(r.duration_s > 0 for r in log)

    monkeypatch.setattr(A, "write_archive", lambda *a, **k: None)     # a write that loses its rows
    more = hot.unionByName(_attempts(spark, [6]).withColumn("attempt_id", F.lit("B")))
    with pytest.raises(A.ArchiveMismatch):
        job(more, "r2")
    failed = spark.read.parquet(where["log"]).filter("status = 'FAILED'").collect()
    assert len(failed) == 1 and failed[0].remaining_rows == 6
    assert A._stored(spark, where["hot"] + "/r2") is None
