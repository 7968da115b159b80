"""The dashboard rollups kept current by Structured Streaming.

The registered rollups add up per-batch partial sums of the rows that the
upsert found new (``_partials``), so late rows count and replays do not.

``tumbling`` is the watermarked form for sinks that must close windows: rows
older than the watermark are dropped there.  Its changed rows are appended with
the batch id, and the current value of a key is its row from the latest batch
(``latest``).

KPIs over a rolling horizon (R8) are a ring of panes.  Collusion (R11) keeps its rows in few columns and the answer
groups of each pane; pairs are joined when they are asked for.  The ingested table is not read again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probity.functions.exact import SCALE
from probity.functions.bands import risk_level_pair
from probity.operators import collusion
from probity.session import materialize, work_dir
from probity.streaming.ingest import ingest_stats, run_available_now, upsert
from probity.streaming.runs import Log, Sums


def tumbling(df: DataFrame, minutes: int, keys: list[str], aggs: list, ts: str = "event_ts",
             delay: str | None = None) -> DataFrame:
    """Tumbling event-time window aggregate.  Pass ``delay`` unless ``df``
    already carries a watermark (e.g. from ``dedup``).  ``window_start`` is
    returned as wall-clock ``timestamp_ntz`` like the batch rollups."""
    d = df.withWatermark(ts, delay) if delay else df
    g = d.groupBy(F.window(ts, f"{minutes} minutes").alias("w"), *keys).agg(*aggs)
    return (g.withColumn("window_start", F.col("w.start").cast("timestamp_ntz")).drop("w")
            .select("window_start", *keys, *[c for c in g.columns if c not in ("w", *keys)]))


def _append_with_batch(path: str, keys: list[str] | None = None, compact_every: int | None = None):
    """foreachBatch sink: append the batch's updated rows under ``_batch=<id>``;
    every ``compact_every`` batches compact the folder (same thread as the
    stream, so compaction never races an append)."""
    def fn(batch: DataFrame, batch_id: int):
        (batch.withColumn("_batch", F.lit(batch_id)).write.mode("append")
         .partitionBy("_batch").parquet(path))
        if compact_every and keys and (batch_id + 1) % compact_every == 0:
            compact(batch.sparkSession, path, keys, batch_id)
    return fn


def latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Current value per key from an update-mode sink folder."""
    df = spark.read.parquet(path)
    vals = [c for c in df.columns if c not in keys and c != "_batch"]
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*vals), "_batch").alias("v"))
            .select(*keys, *[F.col(f"v.{c}").alias(c) for c in vals]))


def compact(spark: SparkSession, path: str, keys: list[str], batch_id: int) -> None:
    """Collapse the sink to one row per key, in an order that is safe to
    interrupt:

    1. the current rows are written once to the work folder (a path cannot
       be overwritten while it is being read);
    2. they replace partition ``_batch=<batch_id>`` (dynamic partition
       overwrite) -- that partition now holds every current row;
    3. only then are the older batch partitions, all superseded, deleted.

    Stopping before 3 leaves superseded rows that ``latest`` ignores; a
    failure in 2 fails the micro-batch, which the stream retries.
    """
    cur = materialize(latest(spark, path, keys).withColumn("_batch", F.lit(batch_id)),
                      "sink-compact")
    (cur.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("_batch").parquet(path))
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("_batch=") and int(name.split("=", 1)[1]) < batch_id:
            fs.delete(status.getPath(), True)


def run_update_window(df: DataFrame, name: str, keys: list[str],
                      compact_every: int | None = 50) -> DataFrame:
    """Drain ``df`` (an update-mode aggregate) into a sink; return the result."""
    spark = df.sparkSession
    out = work_dir(spark, f"sink-{name}")
    run_available_now(df, _append_with_batch(out, keys, compact_every), name, output_mode="update")
    return latest(spark, out, keys)


def _partials(attempts: DataFrame, name: str, keys: list[str], aggs: list, shape=None) -> DataFrame:
    """Additive aggregates kept per micro-batch, and summed on read.

    Each batch adds the sums of its new rows (after the upsert, so a repeated
    message adds nothing) as a run of its own; a replay overwrites it, and runs of
    earlier batches are merged (``runs.Sums``).  A late row is counted when it comes,
    however late: no watermark closes a window.
    """
    spark = attempts.sparkSession
    sums = Sums(spark, work_dir(spark, f"partials-{name}"), keys, [])

    def on_new(rows: DataFrame, batch_id: int):
        rows = shape(rows) if shape else rows
        out = rows.groupBy(*keys).agg(*aggs)
        sums.sums = [c for c in out.columns if c not in keys]
        sums.add(out, batch_id)

    ingest_table(attempts, name, on_new=on_new)
    return sums.total()


def _sum(c: str):
    return F.sum(F.col(c).cast(SCALE)).alias(c)


def _windowed(minutes: int):
    start = F.window(F.col("submission_timestamp").cast("timestamp"), f"{minutes} minutes")["start"]
    return lambda rows: rows.withColumn("window_start", start.cast("timestamp_ntz"))


def stream_tumbling(attempts: DataFrame, minutes: int = 5, by_exam: bool = True) -> DataFrame:
    """R6 (5 min x exam, A10) / R7 (10 min, A11) over the ingested rows."""
    keys = ["window_start", *(["exam_id"] if by_exam else [])]
    aggs = [_sum("ai_usage_score"), _sum("response_time"),
            F.count("ai_usage_score").alias("n_ai"), F.count("response_time").alias("n_rt"),
            F.count(F.lit(1)).alias("total_events")]
    p = _partials(attempts, f"tumbling{minutes}", keys, aggs, _windowed(minutes))
    ratio = lambda c, n: F.col(c).cast("double") / F.nullif(F.col(n), F.lit(0))
    return p.select(*keys, ratio("ai_usage_score", "n_ai").alias("avg_ai_score"),
                    ratio("response_time", "n_rt").alias("avg_response_time"), "total_events")


def stream_event_rate(attempts: DataFrame) -> DataFrame:
    """Events per 1-minute window."""
    return _partials(attempts, "rate", ["window_start"], [F.count(F.lit(1)).alias("events")], _windowed(1))


def stream_high_risk_state(attempts: DataFrame, k: int = 20, threshold: float = 0.7) -> DataFrame:
    """R10 kept as additive state: per-student score sums and counts, top-k on read."""
    p = _partials(attempts, "students", ["student_id"],
                  [_sum("ai_usage_score"), F.count("ai_usage_score").alias("n"), F.count(F.lit(1)).alias("attempts")])
    s = p.withColumn("avg_ai", F.col("ai_usage_score").cast("double") / F.nullif(F.col("n"), F.lit(0)))
    return (s.filter(F.col("avg_ai") >= threshold).orderBy(F.desc("avg_ai"), "student_id").limit(k)
            .select("student_id", F.round("avg_ai", 3).alias("ai_score"), "attempts"))


def stream_high_risk(attempts: DataFrame, k: int = 20, threshold: float = 0.7) -> DataFrame:
    """The top-k high-risk students of everything ingested so far."""
    return stream_high_risk_state(attempts, k, threshold)


def ingest_table(attempts: DataFrame, name: str = "ingest", on_batch=None, on_new=None,
                 key: str = "attempt_id", ts: str = "submission_timestamp", query: list | None = None) -> str:
    """Upsert the stream into a table folder partitioned by day.

    No watermark stands before the upsert: a late row is a new row.  ``on_new(rows,
    batch_id)`` gets each batch's new rows, ``on_batch(spark, table, as_of)`` runs after
    it with the greatest event time of the table's statistics (and so survives a
    restart).  ``query`` receives the finished StreamingQuery.  Returns the table
    folder; ``<table>_stats`` and ``<table>_rejects`` lie beside it."""
    spark = attempts.sparkSession
    table = work_dir(spark, f"table-{name}")

    def fn(batch: DataFrame, batch_id: int):
        upsert(batch.drop("event_ts"), table, key, ts=ts, batch_id=batch_id, topic=name,
               on_new=(lambda rows: on_new(rows, batch_id)) if on_new else None)
        if on_batch is not None:
            sp = batch.sparkSession
            on_batch(sp, table, ingest_stats(sp, table).agg(F.max("max_ts")).first()[0])

    q = run_available_now(attempts, fn, name)
    if query is not None:
        query.append(q)
    return table


def _parse_interval(spec: str) -> dt.timedelta:
    n, unit = spec.split()
    unit = unit.rstrip("s")
    names = {"minute": "minutes", "hour": "hours", "day": "days"}
    return dt.timedelta(**{names[unit]: int(n)})


def _micros(c):
    return F.unix_micros(F.col(c).cast("timestamp") if isinstance(c, str) else c.cast("timestamp"))


class Horizon:
    """A rolling horizon over panes of ``pane`` microseconds: the panes that are whole inside it, and
    the one its start cuts."""

    def __init__(self, lookback: str, pane: str):
        size = dt.timedelta(microseconds=1)
        self.length, self.pane = _parse_interval(lookback) // size, _parse_interval(pane) // size

    def start(self, as_of: int) -> int:
        return as_of - self.length

    def of(self, t):
        return (F.floor(t / self.pane) * self.pane).cast("long")

    def cut(self, as_of: int) -> int:
        """Start of the pane that holds the horizon's start."""
        return self.start(as_of) // self.pane * self.pane

    def whole(self, as_of: int) -> int:
        """Start of the first pane that is wholly inside."""
        return -(-self.start(as_of) // self.pane) * self.pane


class RollingKpis:
    """The A9 rollup over a rolling horizon as a ring of panes.

    A batch adds its new rows' sums by (pane, student, exam), and the rows' few columns by
    pane.  The current rollup is the sum of the whole panes and of the rows of the one
    pane that the horizon's start cuts; the ingested table is not read again.  Panes
    that the horizon has left go when runs are merged.  Squares are summed as decimals of
    response times to four places, so a late merge gives the same deviation.
    """

    COLUMNS = ["student_id", "exam_id", "response_time", "is_correct", "ai_usage_score", "submission_timestamp"]

    def __init__(self, spark: SparkSession, root: str, lookback: str = "2 hours", pane: str = "1 minute"):
        self.horizon = Horizon(lookback, pane)
        self.sums = Sums(spark, f"{root}/sums", ["pane", "student_id", "exam_id"],
                         ["ai", "n_ai", "rt", "n_rt", "x", "xx", "correct", "n"], ["last_updated"])
        self.log = Log(spark, f"{root}/rows")

    def _sum(self, rows: DataFrame) -> DataFrame:
        x = F.col("response_time").cast("decimal(14,4)")
        return rows.groupBy("pane", "student_id", "exam_id").agg(
            _sum("ai_usage_score").alias("ai"), F.count("ai_usage_score").alias("n_ai"),
            _sum("response_time").alias("rt"), F.count("response_time").alias("n_rt"),
            F.sum(x).cast("decimal(18,4)").alias("x"), F.sum((x * x).cast("decimal(28,8)")).cast("decimal(28,8)").alias("xx"),
            F.count(F.when(F.col("is_correct"), 1)).alias("correct"), F.count(F.lit(1)).alias("n"),
            F.max("submission_timestamp").alias("last_updated"))

    def add(self, rows: DataFrame, batch: int, as_of: int | None = None) -> None:
        """``as_of``: greatest event time (microseconds) of earlier batches; panes before its horizon may go."""
        rows = rows.select(self.horizon.of(_micros("submission_timestamp")).alias("pane"), *self.COLUMNS)
        live = None if as_of is None else F.col("pane") >= self.horizon.cut(as_of)
        rows = rows if live is None else rows.filter(live)
        self.log.add(rows, batch, live)
        self.sums.add(self._sum(rows), batch, live)

    def current(self, as_of: int) -> DataFrame:
        edge = self.log.rows().filter((F.col("pane") == self.horizon.cut(as_of)) & (F.col("pane") < self.horizon.whole(as_of))
                                      & (_micros("submission_timestamp") >= self.horizon.start(as_of)))
        parts = self.sums.total().filter(F.col("pane") >= self.horizon.whole(as_of)).unionByName(self._sum(edge))
        g = parts.groupBy("student_id", "exam_id").agg(
            *[F.sum(c).alias(c) for c in ("ai", "n_ai", "rt", "n_rt", "x", "xx", "correct", "n")], F.max("last_updated").alias("last_updated"))
        ratio = lambda c, n: F.col(c).cast("double") / F.nullif(F.col(n), F.lit(0))
        n, x = F.col("n_rt").cast("decimal(9,0)"), F.col("x").cast("decimal(18,4)")
        spread = (n * F.col("xx").cast("decimal(28,8)") - x * x).cast("double")
        return g.select("student_id", "exam_id", ratio("rt", "n_rt").alias("avg_response_time"),
                        (ratio("correct", "n") * 100).alias("accuracy_rate"), ratio("ai", "n_ai").alias("avg_ai_score"),
                        (F.sqrt(spread) / F.nullif(F.col("n_rt"), F.lit(0))).alias("response_variance"),
                        F.col("n").alias("total_attempts"), "last_updated").withColumn("risk_level", risk_level_pair("avg_ai_score"))


class CollusionState:
    """A20 over a rolling horizon, from kept rows.

    A batch adds its rows, in few columns, and counts its recent ones by (answer group, pane).  A match needs a
    recent row, so the pairs are those of the groups that have one in a pane of the horizon: they are joined when they
    are asked for, by blocks of students (``collusion.collusion_pairs``).  The state grows with the rows; sums by
    (pair, question, pane) would be as many as the matches.
    """

    KEYS = [*collusion.GROUP, "pane"]

    def __init__(self, spark: SparkSession, root: str, lookback: str = "2 hours", pane: str = "10 minutes"):
        self.horizon = Horizon(lookback, pane)
        self.log = Log(spark, f"{root}/members")
        self.sums = Sums(spark, f"{root}/sums", self.KEYS, ["n"])

    def add(self, rows: DataFrame, batch: int, as_of: int | None = None) -> None:
        new = rows.select(*collusion.GROUP, F.col("student_id").alias("s"), _micros("submission_timestamp").alias("t")).dropna()
        # the horizon never goes back, so what lies before that of the batch's own newest row is not needed either
        newest = [t for t in (as_of, new.agg(F.max("t")).first()[0]) if t is not None]
        as_of = max(newest) if newest else None
        live = None if as_of is None else F.col("pane") >= self.horizon.cut(as_of)
        paned = new.withColumn("pane", self.horizon.of(F.col("t")))
        paned = paned if live is None else paned.filter(live)
        self.sums.add(paned.groupBy(*self.KEYS).agg(F.count(F.lit(1)).alias("n")), batch, live)
        self.log.add(new, batch)

    def current(self, as_of: int, min_matches: int = 3) -> DataFrame:
        groups = self.sums.total().filter(F.col("pane") >= self.horizon.cut(as_of)).select(*collusion.GROUP).distinct()
        rows = self.log.rows().join(groups, collusion.GROUP, "left_semi").select(
            *collusion.GROUP, F.col("s").alias("student_id"), F.timestamp_micros("t").alias("submission_timestamp"))
        return collusion.collusion_pairs(rows, F.timestamp_micros(F.lit(as_of)), f"{self.horizon.length} microseconds", min_matches)


def _kept(attempts: DataFrame, name: str, state, on_current=None):
    """Feed ``state`` with the new rows of every batch; returns the last as_of.  ``on_current``
    gets the state and the as_of after each batch."""
    seen: list[int] = []

    def latest(spark, table):
        return ingest_stats(spark, table).agg(F.max(_micros("max_ts"))).first()[0]

    def on_batch(spark, table, _as_of):
        as_of = latest(spark, table)
        if as_of is not None:
            seen.append(as_of)
            if on_current is not None:
                on_current(state, as_of)

    ingest_table(attempts, name, on_batch, lambda rows, batch: state.add(rows, batch, seen[-1] if seen else None))
    return seen[-1] if seen else 0


def stream_rolling_kpis(attempts: DataFrame, lookback: str = "2 hours", pane: str = "1 minute", on_current=None) -> DataFrame:
    """The A9 rollup over the last ``lookback`` of the stream, kept as panes (``RollingKpis``)."""
    spark = attempts.sparkSession
    state = RollingKpis(spark, work_dir(spark, "rolling-kpis"), lookback, pane)
    return state.current(_kept(attempts, "rolling", state, on_current))


def stream_collusion(attempts: DataFrame, lookback: str = "2 hours", pane: str = "10 minutes", on_current=None) -> DataFrame:
    """The A20 pairs of the last ``lookback`` of the stream, kept by delta joins (``CollusionState``)."""
    spark = attempts.sparkSession
    state = CollusionState(spark, work_dir(spark, "collusion"), lookback, pane)
    return state.current(_kept(attempts, "collusion", state, on_current))
