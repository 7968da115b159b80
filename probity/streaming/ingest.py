"""Stream sources and sinks: S3, S4, K3, K9 and R1-R5.

Production source is Kafka (two topics, earliest offsets); tests and the
registered queries use a file source over the same records.  Event time is
cast to ``timestamp`` (watermarks reject ``timestamp_ntz``).

Delivery: checkpointed offsets plus an idempotent sink (K3 anti-joins on
the unique key), so a replayed micro-batch after a failure inserts nothing
twice -- exactly-once effect on top of at-least-once delivery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from probity import schemas
from probity.functions.timecols import parse_iso
from probity.session import work_dir
from probity.streaming.runs import KeyIndex, exists

CORRUPT = "_corrupt_record"


def read_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                topic: str | None = None, schema: T.StructType | None = None,
                options: dict | None = None, max_per_trigger: int | None = None) -> DataFrame:
    """S3: subscribe to ``topic`` from the earliest offset (``kafka``), or
    tail files under ``path`` (``json``/``text``/``parquet``).

    R3: ``max_per_trigger`` bounds a micro-batch (offsets for Kafka, files
    for a file source) -- the buffered-insert size of the original consumer."""
    r = spark.readStream.format(fmt)
    if fmt == "kafka":
        r = r.option("subscribe", topic).option("startingOffsets", "earliest")
    if max_per_trigger is not None:
        r = r.option("maxOffsetsPerTrigger" if fmt == "kafka" else "maxFilesPerTrigger",
                     max_per_trigger)
    if schema is not None:
        r = r.schema(schema)
    r = r.options(**(options or {}))
    return r.load(path) if path else r.load()


def decode(df: DataFrame, schema: T.StructType, ts_fields: list[str],
           value: Column | None = None) -> DataFrame:
    """S4 + X6: JSON message -> typed record.

    Malformed JSON keeps the raw text in ``_corrupt_record``; timestamps are
    parsed from ISO-8601 (``Z`` accepted).  ``_valid`` is false for malformed
    records or unparsable required timestamps -- route those to quarantine
    instead of dropping them silently.
    """
    v = value if value is not None else F.col("value").cast("string")
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    parsed = df.select(F.from_json(v, full, {"columnNameOfCorruptRecord": CORRUPT,
                                             "mode": "PERMISSIVE"}).alias("m")).select("m.*")
    raw = parsed.withColumns({f"_raw_{c}": F.col(c) for c in ts_fields})
    typed = raw.withColumns({c: parse_iso(F.col(c)) for c in ts_fields})
    ok = F.col(CORRUPT).isNull()
    for c in ts_fields:  # absent is allowed here; present but unparsable is not
        ok = ok & (F.col(c).isNotNull() | F.col(f"_raw_{c}").isNull())
    return (typed.withColumn("_valid", ok & F.col(ts_fields[0]).isNotNull())
            .drop(*[f"_raw_{c}" for c in ts_fields]))


def encode(df: DataFrame, key: str | None = None, ts_fields: list[str] | None = None) -> DataFrame:
    """K9: one JSON message per row (timestamps as ISO-8601 text)."""
    cols = [F.date_format(F.col(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(c)
            if c in (ts_fields or []) else F.col(c) for c in df.columns]
    out = df.select(F.to_json(F.struct(*cols)).alias("value"),
                    *([F.col(key).cast("string").alias("key")] if key else []))
    return out


def publish(df: DataFrame, topic: str, bootstrap: str | None = None, key: str | None = None,
            ts_fields: list[str] | None = None, partitions: int = 8) -> None:
    """K9 sink: send the encoded rows to a topic (batch).

    With ``bootstrap`` the topic is a Kafka topic of those servers; without, it is a folder
    of message files, which ``read_stream`` follows.  A message's key picks its partition, so the
    messages of a key stay in one."""
    out = encode(df, key, ts_fields)
    if bootstrap is not None:
        out.write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save()
        return
    by = F.xxhash64("key" if key else "value")
    out.repartition(partitions, by).write.mode("append").parquet(topic)


MESSAGE = T.StructType([T.StructField("value", T.StringType()), T.StructField("key", T.StringType())])


def attempts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's events table as a stream of exam attempts (file source),
    with ``event_ts`` as a watermarkable timestamp."""
    from probity.sources.tables import attempts_from_events
    ev = read_stream(spark, "parquet", sf_dir, schema=schemas.EVENTS,
                     options={"pathGlobFilter": "events.parquet"})
    return attempts_from_events(ev).withColumn("event_ts", F.col("submission_timestamp").cast("timestamp"))


def dedup(df: DataFrame, key: str, ts: str = "event_ts", delay: str = "2 hours") -> DataFrame:
    """R2: drop repeated keys seen within the watermark delay (bounded state)."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


NO_KEY = "missing key"


def upsert(batch: DataFrame, target: str, key: str, ts: str | None = None, batch_id: int = 0,
           topic: str = "", on_new=None) -> dict:
    """K3: append the batch's rows whose key is new; repeated keys, inside the
    batch or from any earlier batch, are skipped and counted.

    A key is unique over the whole table, whatever its event time.  ``<target>_keys``
    lists the keys (``runs.KeyIndex``); a batch reads the buckets that may hold one of
    its keys.  Of rows that share a key the earliest event wins, then the smaller
    row hash.  Rows that decoding marked invalid (``_valid`` false), and rows without a
    key, go to ``<target>_rejects`` with the reason.

    Safe to replay: keys that this same batch listed before do not count as known;
    a batch lists its keys before it writes its rows, so a list of its own tells that
    rows of it may be there, and only then the days it writes to are read.  Its part of
    the key list, rejects and statistics are overwritten.
    ``on_new(rows)`` gets the batch's new rows, the same ones on a replay.
    Returns, and stores in ``<target>_stats``, the batch's counts.
    """
    spark = batch.sparkSession
    index = KeyIndex(spark, f"{target}_keys", key)
    b = batch.persist()        # one micro-batch: bounded, recomputable from the source
    decoded = "_valid" in b.columns
    whole = (F.col("_valid") if decoded else F.lit(True)) & F.col(key).isNotNull()
    seen = b.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(whole, 1)).alias("valid"),
                 F.max(F.when(whole, F.col(ts)) if ts else F.lit(None).cast("timestamp")).alias("max_ts"))
    seen = seen.first()
    if seen["valid"] < seen["rows"]:
        why = F.lit(NO_KEY)
        if decoded:
            why = (F.when(F.col(CORRUPT).isNotNull(), "malformed message")
                   .when(~F.col("_valid"), "missing or unreadable time").otherwise(why))
        (b.filter(~whole).withColumn("reason", why).drop("_valid")
         .write.mode("overwrite").parquet(f"{target}_rejects/_batch={batch_id}"))
    good = b.filter(whole).drop("_valid", CORRUPT)
    cols = good.columns
    first = F.struct(*([F.col(ts)] if ts else []), F.xxhash64(*cols))
    rows = good.groupBy(key).agg(F.min_by(F.struct(*cols), first).alias("r")).select("r.*").persist()
    index.compact(batch_id)
    known = index.known(rows, batch_id)
    if known is not None:
        every, rows = rows, rows.join(known, key, "left_anti").persist()
        inserted = rows.count()
        every.unpersist()
    else:
        inserted = rows.count()
    again = bool(index.runs.own(batch_id))
    index.add(rows.select(key), inserted, batch_id)
    new = rows
    if ts is not None:
        new = new.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)})
    if again and exists(spark, target):
        there = spark.read.parquet(target)
        if ts is not None:
            there = there.join(F.broadcast(new.select("year", "month", "day").distinct()),
                               ["year", "month", "day"], "left_semi") if _few_days(new) else there
        new = new.join(there.select(key), key, "left_anti")
    w = new.write.mode("append")
    if ts is not None:
        # a day's rows meet in one file, or in several of a bounded size if they are many
        w = new.hint("rebalance", "year", "month", "day").write.mode("append").partitionBy("year", "month", "day")
    w.parquet(target)
    if on_new is not None:
        on_new(rows)
    stats = spark.createDataFrame(
        [(topic, seen["rows"], inserted, seen["valid"] - inserted, seen["rows"] - seen["valid"], seen["max_ts"])],
        T.StructType([T.StructField("topic", T.StringType()),
                      *[T.StructField(c, T.LongType()) for c in ("input_rows", "inserted", "duplicates", "rejected")],
                      T.StructField("max_ts", b.schema[ts].dataType if ts else T.TimestampType())]))
    stats.coalesce(1).write.mode("overwrite").parquet(f"{target}_stats/_batch={batch_id}")
    rows.unpersist()
    b.unpersist()
    return {"rows": seen["rows"], "inserted": inserted, "duplicates": seen["valid"] - inserted,
            "rejected": seen["rows"] - seen["valid"]}


def _few_days(rows: DataFrame, limit: int = 10_000) -> bool:
    """Whether the batch's distinct days may be broadcast."""
    return rows.select("year", "month", "day").distinct().limit(limit + 1).count() <= limit


def ingest_stats(spark: SparkSession, target: str) -> DataFrame:
    """One row per micro-batch, from the table the upserts wrote."""
    return spark.read.parquet(f"{target}_stats")


def run_available_now(df: DataFrame, batch_fn, name: str, output_mode: str = "append",
                      checkpoint: str | None = None) -> StreamingQuery:
    """Process everything available, then stop (drain)."""
    ckpt = checkpoint or work_dir(df.sparkSession, f"ckpt-{name}")
    q = (df.writeStream.outputMode(output_mode).foreachBatch(batch_fn)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def progress(q: StreamingQuery) -> list[dict]:
    """Per micro-batch rows in, rate and observed metrics."""
    out = []
    for p in q.recentProgress:
        out.append({"batch": p.get("batchId"), "input_rows": p.get("numInputRows"),
                    "rows_per_second": p.get("processedRowsPerSecond"),
                    "metrics": p.get("observedMetrics", {})})
    return out
