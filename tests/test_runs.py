"""Key index, merged runs and the upsert over many batches."""

import datetime as dt
import os

from pyspark.sql import functions as F

from probity.session import work_dir
from probity.streaming import ingest as I
from probity.streaming.runs import KeyIndex, Runs, Sums


def keys_of(spark, lo, hi):
    return spark.range(lo, hi, 1, 1).select(F.concat(F.lit("K"), F.col("id")).alias("k"))


def test_keys_read_stay_in_proportion_to_the_batch(spark):
    """50 batches of 200 keys, of which 5 repeat: the keys read do not grow with the keys held."""
    index = KeyIndex(spark, work_dir(spark, "keys"), "k", fan=4, bucket_keys=128)
    read, files = [], 0
    for b in range(50):
        batch = keys_of(spark, b * 195, b * 195 + 200)          # the last 5 keys of the batch before come again
        index.compact(b)
        known = index.known(batch, b)
        n = 0 if known is None else known.count()
        read.append(n)
        old = 5 if b else 0
        if b % 10 == 9:                                         # a Bloom filter has no false negatives
            assert batch.join(known, "k", "left_semi").count() == old
        index.add(keys_of(spark, b * 195 + old, b * 195 + 200), 200 - old, b)
    held = sum(spark.read.parquet(r.path).count() for r in index.runs.all())
    assert held == 50 * 195 + 5
    early, late = sum(read[5:15]) / 10, sum(read[40:]) / 10
    print("keys read per batch of 200:", read)
    # the 5 repeated keys alone touch up to 5 buckets of 64 to 128 keys
    assert late <= 4 * 200 and late <= 2 * early and late < held / 10
    runs = index.runs.all()
    assert len(runs) <= 3 * 4
    for r in runs:                                             # one file a bucket, as many buckets as keys ask for
        for name in os.listdir(r.path):
            if name.startswith("bucket="):
                files = [f for f in os.listdir(f"{r.path}/{name}") if f.endswith(".parquet")]
                assert len(files) == 1
                assert spark.read.parquet(f"{r.path}/{name}").count() < 2 * 128


def test_a_merged_run_replaces_those_it_covers_and_a_replay_does_not_see_its_own(spark):
    index = KeyIndex(spark, work_dir(spark, "keys"), "k", fan=2)
    for b in range(4):
        index.compact(b)
        index.add(keys_of(spark, 10 * b, 10 * b + 10), 10, b)
    index.compact(3)
    again = keys_of(spark, 30, 40)
    assert index.known(again, 3) is None or again.join(index.known(again, 3), "k", "left_semi").count() == 0
    assert again.join(index.known(again, 4), "k", "left_semi").count() == 10
    # a stop after a merge, before the covered runs went: they are ignored
    runs = Runs(spark, work_dir(spark, "stop"))
    for b in range(2):
        runs.put(keys_of(spark, b, b + 1), b)
    keys_of(spark, 0, 2).write.parquet(runs.path(1, 0, 1))
    assert [(r.level, r.first, r.last) for r in runs.all()] == [(1, 0, 1)]
    keys_of(spark, 0, 9).write.parquet(runs.path(1, 2, 5))
    os.remove(f"{runs.path(1, 2, 5)}/_SUCCESS")                 # an unfinished run does not count
    assert len(runs.all()) == 1


def test_sums_survive_merging_and_replay(spark):
    sums = Sums(spark, work_dir(spark, "sums"), ["k"], ["n"], ["top"], fan=3)
    for b in [*range(11), 10, 10]:                              # the last batch comes three times
        rows = spark.range(b, b + 4, 1, 1).select((F.col("id") % 3).alias("k"), F.lit(1).alias("n"), F.col("id").alias("top"))
        sums.add(rows.groupBy("k").agg(F.sum("n").alias("n"), F.max("top").alias("top")), b)
    want = {}
    for b in range(11):
        for i in range(b, b + 4):
            n, top = want.get(i % 3, (0, 0))
            want[i % 3] = (n + 1, max(top, i))
    assert {r.k: (r.n, r.top) for r in sums.total().collect()} == want
    assert len(sums.runs.all()) <= 6


def test_rows_without_a_key_are_rejected_not_merged(spark):
    target = work_dir(spark, "null-keys")
    t = dt.datetime(2024, 1, 1, 10)
    b = spark.createDataFrame([("A1", t), (None, t), (None, t + dt.timedelta(1)), (None, t)],
                              "attempt_id string, submission_timestamp timestamp_ntz")
    got = [I.upsert(b, target, "attempt_id", ts="submission_timestamp", batch_id=k) for k in (0, 1, 1)]
    assert [(g["inserted"], g["duplicates"], g["rejected"]) for g in got] == [(1, 0, 3), (0, 1, 3), (0, 1, 3)]
    assert [r.attempt_id for r in spark.read.parquet(target).collect()] == ["A1"]
    out = spark.read.parquet(f"{target}_rejects")
    assert out.count() == 6 and {r.reason for r in out.collect()} == {I.NO_KEY}
    stats = I.ingest_stats(spark, target).agg(F.sum("input_rows"), F.sum("rejected")).first()
    assert tuple(stats) == (8, 6)
    empty = I.upsert(b.limit(0), target, "attempt_id", ts="submission_timestamp", batch_id=2)
    assert empty == {"rows": 0, "inserted": 0, "duplicates": 0, "rejected": 0}


def test_rows_written_before_a_stop_are_not_written_twice(spark):
    """A batch that stopped after its table write, before its statistics."""
    target = work_dir(spark, "stopped")
    t = dt.datetime(2024, 1, 1, 10)
    b = spark.createDataFrame([(f"A{i}", t + dt.timedelta(days=i)) for i in range(5)],
                              "attempt_id string, submission_timestamp timestamp_ntz")

    def stop(rows):
        raise RuntimeError("executor lost")

    for _ in range(2):
        try:
            I.upsert(b, target, "attempt_id", ts="submission_timestamp", batch_id=4, on_new=stop)
        except RuntimeError:
            pass
    got = I.upsert(b, target, "attempt_id", ts="submission_timestamp", batch_id=4)
    assert got["inserted"] == 5 and spark.read.parquet(target).count() == 5
