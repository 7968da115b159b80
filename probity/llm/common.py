"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probity.session import checkpoint_dir, made


#: Arrow batches are bounded by bytes, so the memory of a Python task does not depend on the
#: length of the texts; a session that names its own bound keeps it.
BATCH_KEY, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", str(4 << 20)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if spark.conf.get(BATCH_KEY) == BATCH_DEFAULT:
        spark.conf.set(BATCH_KEY, BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Written intermediates of one operator call, in the shared folder.

    ``write`` stores a frame as Parquet and returns a reader on it, which cuts
    the lineage and survives a lost executor; ``drop`` deletes what later steps
    no longer read.
    """

    def __init__(self, spark: SparkSession, name: str):
        base = checkpoint_dir(spark).rstrip("/")
        self.spark, self.base, self.n = spark, made(f"{base}/llm-{name}-{uuid.uuid4().hex[:12]}"), 0

    def write(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(col):
    """Lower-case A-Z only.  ``lower`` does the same on pure ASCII and is faster."""
    c = F.coalesce(col, F.lit(""))
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def id_crc(col):
    """crc32 of the id as text."""
    return F.crc32(col.cast("string").cast("binary"))


def components(spark: SparkSession, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (id, root), root the least id.

    Alternating large-star and small-star steps; every step is two shuffles over
    the edges, its result is written and reread, and the loop ends when the edge
    set no longer changes.  Only the edge count and a checksum come to the driver.
    """
    def stat(e):
        r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        return r["n"], r["s"]

    def star(e, large: bool):
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else \
            e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        m = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        j = both.join(m, "a")
        if large:
            out = j.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = j.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                m.select("a", F.col("m").alias("b")))
        return out.filter("a <> b").distinct()

    e = scratch.write(edges.select("a", "b").filter("a <> b").distinct())
    seen = stat(e)
    while seen[0]:
        nxt = scratch.write(star(star(e, True), False))
        now = stat(nxt)
        scratch.drop(e)
        e = nxt
        if now == seen:
            break
        seen = now
    return e.select(F.col("a").alias("id"), F.col("b").alias("root"))
