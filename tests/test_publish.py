"""Published versions, and how many files a day of the archive has."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from probity.operators import archive as A
from probity.operators.publish import Published
from probity.session import work_dir


def test_a_reader_sees_the_old_version_or_the_new_one(spark, monkeypatch):
    path = work_dir(spark, "rollup")
    table = Published(spark, path)
    with pytest.raises(FileNotFoundError):
        table.read()
    A.write_rollup(spark.range(3), path)
    opened = A.read_rollup(spark, path)                        # opened before the next publish
    held = []
    point = Published.point
    monkeypatch.setattr(Published, "point", lambda self, v: (held.append(table.read().count()), point(self, v))[1])
    A.write_rollup(spark.range(10), path)                      # read between the write and the pointer
    assert held == [3]
    assert opened.count() == 3 and A.read_rollup(spark, path).count() == 10
    for n in (20, 30):
        A.write_rollup(spark.range(n), path)
    assert A.read_rollup(spark, path).count() == 30
    assert len(glob.glob(f"{path}/v-*")) == 3                  # two older versions stay for their readers


def test_only_complete_versions_are_published_and_only_once(spark):
    table = Published(spark, work_dir(spark, "hot"))
    with pytest.raises(ValueError):
        table.point("r1")
    table.publish(spark.range(4), "r1")
    table.publish(spark.range(9), "r1")                        # a retry keeps what is complete
    assert table.read().count() == 4 and len(table._pointers()) == 1
    table.publish(spark.range(2), "r2")
    assert table.current().endswith("/r2")


def test_files_per_day_are_bounded_and_a_hot_day_is_split(spark):
    """16 tasks of 30 days each; one day holds two thirds of the rows."""
    base = dt.datetime(2024, 1, 1)
    day = F.when(F.col("id") % 3 > 0, F.lit(4)).otherwise(F.col("id") % 30).cast("int")
    rows = spark.range(0, 60_000, 1, 16).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"),
                                                (F.lit(base) + F.make_dt_interval(days=day)).cast("timestamp_ntz").alias("ts"))
    path = work_dir(spark, "days")
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    try:
        A.write_archive(rows, "ts", path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    files = {d: len(glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{path}/year=*/month=*/day=*")}
    hot = f"{path}/year=2024/month=1/day=5"
    assert len(files) == 11 and files.pop(hot) >= 4 and max(files.values()) <= 2
    assert spark.read.parquet(path).count() == 60_000


def test_an_archival_run_with_nothing_staged_reads_no_archived_day(spark):
    t = dt.datetime(2024, 3, 1)
    rows = spark.createDataFrame([("A", t), ("B", t - dt.timedelta(days=400))], "k string, ts timestamp_ntz")
    where = [work_dir(spark, n) for n in ("arch", "staging")]
    A.run_archival(spark, rows, "ts", "k", *where, t, run_id="r1", hot_path=work_dir(spark, "hot0"))
    hot = work_dir(spark, "hot")
    out = A.run_archival(spark, rows.filter("k = 'A'"), "ts", "k", *where, t, run_id="r2", hot_path=hot)
    assert out["reconcile"].first().n_hot == 0 and A.read_hot(spark, hot).count() == 1
