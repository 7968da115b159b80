"""Cold archive: K1, K4, K8, K10-K12, S2 and A27, A28, A33-A36.

The archive is Parquet partitioned by ``year/month/day`` of the event time.
Archival snapshots the eligible rows *once* (written, then re-read), checks
the written count against the extracted count (A35), and only then derives
the retained hot table with an anti-join on the key -- never by
re-evaluating the time filter, so rows that arrive mid-run are never dropped
unarchived, and nothing goes through the driver.

Date-range reads turn the range into predicates on the partition columns, so
Spark prunes directories (a predicate on the timestamp alone cannot).
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probity.functions.exact import mean
from probity.functions.timecols import as_column, interval
from probity.operators.publish import Published

PARTS = ["year", "month", "day"]


def with_date_parts(df: DataFrame, ts: str) -> DataFrame:
    """Year, month and day-of-month of ``ts``."""
    c = F.col(ts)
    return df.withColumns({"year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c)})


def write_archive(df: DataFrame, ts: str, path: str, extra_partition: str | None = None,
                  max_records_per_file: int = 5_000_000) -> None:
    """K1: append ``df`` to the archive at ``path``.

    The rows are rebalanced by day: a day's rows meet in one task, small days share
    a task, and a day beyond the session's advisory partition size is split over several
    (adaptive execution), so a day has few files and a hot day is no single task.
    """
    parts = PARTS + ([extra_partition] if extra_partition else [])
    # enough partitions that few days share one with a hot day
    n = max(200, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    (with_date_parts(df, ts).hint("rebalance", n, *parts)
     .write.mode("append").option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(*parts).parquet(path))


def write_rollup(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """K2: publish a rollup as a new version at ``path``; its readers see the old
    version or the new one.  Returns the version's folder."""
    return Published(df.sparkSession, path).publish(df, fmt=fmt)


def read_rollup(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The current version of a published rollup."""
    return Published(spark, path).read(fmt)


def read_hot(spark: SparkSession, hot_path: str) -> DataFrame:
    """The hot table that the last successful archival run left."""
    return Published(spark, hot_path).read()


def date_range_filter(date_from: dt.date | None, date_to: dt.date | None) -> Column:
    """Predicate on the partition columns for ``date_from <= day <= date_to``."""
    d = F.make_date("year", "month", "day")
    cond = F.lit(True)
    if date_from is not None:
        cond = cond & (d >= F.lit(date_from))
    if date_to is not None:
        cond = cond & (d <= F.lit(date_to))
    return cond


def read_archive(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 date_from: dt.date | None = None, date_to: dt.date | None = None) -> DataFrame:
    """Read the archive with partition discovery; a missing path yields
    an empty frame with ``schema`` (+ partition columns)."""
    try:
        r = spark.read
        if schema is not None:
            full = T.StructType(list(schema.fields) + [T.StructField(p, T.IntegerType()) for p in PARTS])
            r = r.schema(full)
        df = r.option("basePath", path).parquet(path)
    except Exception as e:  # noqa: BLE001 - only "path does not exist" is tolerated
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        if schema is None:
            raise
        full = T.StructType(list(schema.fields) + [T.StructField(p, T.IntegerType()) for p in PARTS])
        return spark.createDataFrame([], full)
    if date_from is not None or date_to is not None:
        df = df.filter(date_range_filter(date_from, date_to))
    return df


def eligible(hot: DataFrame, ts: str, as_of, age: str = "48 hours") -> DataFrame:
    """rows older than ``age`` at ``as_of``."""
    return hot.filter(F.col(ts) < as_column(as_of) - interval(age))


def retain_hot(hot: DataFrame, archived: DataFrame, key: str) -> DataFrame:
    """K4: hot rows whose key is not in the archive (anti-join, no collect)."""
    return hot.join(archived.select(key).distinct(), key, "left_anti")


def archive_eligibility(hot: DataFrame, ts: str, as_of, age: str = "48 hours") -> DataFrame:
    """Number of rows older than ``age`` and whether any exist."""
    n = eligible(hot, ts, as_of, age).agg(F.count(F.lit(1)).alias("n"))
    return n.select((F.col("n") > 0).alias("eligible"), "n")


def archive_partitions(archive: DataFrame) -> DataFrame:
    """Distinct (year, month, day)."""
    return archive.select(*PARTS).distinct()


def manifest(archive: DataFrame, location: str) -> DataFrame:
    """K8: one row: location, total record count, sorted partition list
    (``year=Y/month=M/day=D`` paths).

    The list holds one entry per day partition (bounded by the calendar, not
    by the row count)."""
    per_day = archive.groupBy(*PARTS).agg(F.count(F.lit(1)).alias("records"))
    path = F.format_string("year=%d/month=%d/day=%d", *[F.col(p) for p in PARTS])
    return per_day.agg(
        F.sum("records").alias("record_count"),
        F.array_sort(F.collect_list(path)).alias("partitions"),
    ).select(F.lit(location).alias("location"),
             F.coalesce("record_count", F.lit(0)).cast("long").alias("record_count"),
             "partitions")


def write_manifest(archive: DataFrame, location: str, out: str) -> None:
    manifest(archive, location).coalesce(1).write.mode("overwrite").json(out)


def restore(archive: DataFrame, hot: DataFrame, key: str, date_from: dt.date | None = None,
            date_to: dt.date | None = None) -> DataFrame:
    """Hot table plus the archived rows of a date range that are not
    already hot (anti-join on the key)."""
    a = archive.filter(date_range_filter(date_from, date_to)).drop(*PARTS)
    back = a.join(hot.select(key), key, "left_anti")
    return hot.unionByName(back.select(*hot.columns))


def reconcile(extracted: DataFrame, archived: DataFrame, table: str,
              tolerance_pct: float = 0.1) -> DataFrame:
    """Extracted vs archived counts; ok when the discrepancy is within
    ``tolerance_pct`` percent.  Both counts are one-row aggregates combined
    with a union + aggregate (no cross join)."""
    c = (extracted.select(F.lit(1).alias("x"), F.lit(0).alias("y"))
         .unionByName(archived.select(F.lit(0).alias("x"), F.lit(1).alias("y")))
         .agg(F.sum("x").alias("n_hot"), F.sum("y").alias("n_archived")))
    n_hot = F.coalesce(F.col("n_hot"), F.lit(0)).cast("long")
    n_arc = F.coalesce(F.col("n_archived"), F.lit(0)).cast("long")
    pct = F.when(n_hot == 0, F.when(n_arc == 0, 0.0).otherwise(100.0)).otherwise(
        F.abs(n_hot - n_arc) / n_hot * 100)
    return c.select(F.lit(table).alias("table"), n_hot.alias("n_hot"), n_arc.alias("n_archived"),
                    pct.alias("pct"), (pct <= tolerance_pct).alias("ok"))


def archive_quality(archive: DataFrame, key: str, required: list[str]) -> DataFrame:
    """Completeness (share of rows with all required fields), null
    count over the required fields, duplicate keys (rows - distinct keys)."""
    any_null = None
    nulls = F.lit(0)
    for c in required:
        any_null = F.col(c).isNull() if any_null is None else (any_null | F.col(c).isNull())
        nulls = nulls + F.col(c).isNull().cast("int")
    # per-key partial sums first (two plain aggregates, no Expand): the
    # duplicate count is rows minus non-null distinct keys
    per_key = archive.groupBy(key).agg(F.count(F.lit(1)).alias("n"),
                                       F.sum((~any_null).cast("long")).alias("complete"),
                                       F.sum(nulls).alias("nulls"))
    return per_key.agg(
        (F.sum("complete") / F.sum("n")).alias("completeness"),
        F.sum("nulls").cast("long").alias("null_count"),
        (F.sum("n") - F.count(F.when(F.col(key).isNotNull(), 1))).cast("long").alias("duplicate_count"))


def monthly_trend(archive: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """Average AI score and attempts by (year, month); optional month filter
    (a partition predicate)."""
    a = archive
    if year is not None:
        a = a.filter(F.col("year") == year)
    if month is not None:
        a = a.filter(F.col("month") == month)
    return a.groupBy("year", "month").agg(mean("ai_usage_score").alias("avg_ai_score"),
                                          F.count(F.lit(1)).alias("attempts"))


def student_history(archive: DataFrame, student_id: str | None = None) -> DataFrame:
    """Average response time and accuracy per (student, exam)."""
    a = archive if student_id is None else archive.filter(F.col("student_id") == student_id)
    return a.groupBy("student_id", "exam_id").agg(
        mean("response_time").alias("avg_response_time"),
        (mean(F.col("is_correct").cast("int")) * 100).alias("accuracy_rate"))


def log_run(spark: SparkSession, started: float, rows_archived: DataFrame,
            remaining: DataFrame, status: str = "SUCCESS") -> DataFrame:
    """One audit row per run (timestamp, rows archived, duration,
    status, rows left hot); the counts stay aggregates until written."""
    a = rows_archived.agg(F.count(F.lit(1)).alias("rows_archived"))
    r = remaining.agg(F.count(F.lit(1)).alias("remaining_rows"))
    both = (a.select("rows_archived", F.lit(None).cast("long").alias("remaining_rows"))
            .unionByName(r.select(F.lit(None).cast("long").alias("rows_archived"), "remaining_rows"))
            .agg(F.max("rows_archived").alias("rows_archived"),
                 F.max("remaining_rows").alias("remaining_rows")))
    return both.select(F.current_timestamp().alias("run_at"), "rows_archived",
                       F.lit(round(time.time() - started, 3)).alias("duration_s"),
                       F.lit(status).alias("status"), "remaining_rows")


def register_archive(spark: SparkSession, name: str, path: str, schema: T.StructType) -> None:
    """External table over the archive, then discover new partitions."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}, year INT, month INT, day INT) "
              f"USING parquet PARTITIONED BY (year, month, day) LOCATION '{path}'")
    spark.catalog.recoverPartitions(name)


class ArchiveMismatch(RuntimeError):
    """The archive does not hold what was extracted; the hot table was not touched."""


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The completed Parquet table at ``path``, or None."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return None
    return spark.read.parquet(path)


def run_archival(spark: SparkSession, hot: DataFrame, ts: str, key: str, archive_path: str,
                 staging_path: str, as_of, age: str = "48 hours", run_id: str = "run",
                 table: str = "hot", tolerance_pct: float = 0.1, hot_path: str | None = None,
                 log_path: str | None = None) -> dict:
    """R12 / the hourly archival job, in this order:

    1. The eligible rows are written under ``run_id``; a retry of the run reads
       that snapshot again.
    2. Rows that the archive does not hold yet are appended.  Only the staged
       days are read, so a retry appends nothing twice.
    3. The counts are compared.  Beyond ``tolerance_pct`` percent the run is
       logged as FAILED and raises ``ArchiveMismatch``; nothing is deleted.
    4. The retained rows are published as version ``run_id`` at ``hot_path``
       (``read_hot`` gives the current one); a version that is complete is never
       written over, so its readers keep it.
    5. One row with the measured duration is appended at ``log_path``.

    Without ``hot_path`` the retained frame is returned unwritten."""
    started = time.time()
    staging = f"{staging_path}/{run_id}"
    staged = _stored(spark, staging)
    if staged is None:
        eligible(hot, ts, as_of, age).write.mode("overwrite").parquet(staging)
        staged = spark.read.schema(hot.schema).parquet(staging)
    days = with_date_parts(staged, ts).select(*PARTS).distinct()

    def held():
        # the staged days only, whatever lies between them: partitions are pruned by the days at run time
        return read_archive(spark, archive_path, hot.schema).join(days, PARTS, "left_semi").select(key)

    write_archive(staged.join(held(), key, "left_anti").select(*hot.columns), ts, archive_path)
    found = held().join(staged.select(key).distinct(), key, "left_semi")
    # one row, written: the decision and the caller read the same counts
    check = spark.createDataFrame(reconcile(staged, found, table, tolerance_pct).collect(),
                                  "table string, n_hot long, n_archived long, pct double, ok boolean")
    ok = check.first()["ok"]
    remaining = retain_hot(hot, staged, key)
    if ok and hot_path is not None:
        version = Published(spark, hot_path).publish(remaining, run_id)
        remaining = spark.read.schema(remaining.schema).parquet(version)
    log = log_run(spark, started, staged, remaining if ok else hot, "SUCCESS" if ok else "FAILED")
    if log_path is not None:
        log.write.mode("append").parquet(log_path)
        log = spark.read.parquet(log_path)
    if not ok:
        raise ArchiveMismatch(f"{table}: {check.first().asDict()}")
    return {"reconcile": check, "hot": remaining, "log": log}
