"""Session construction and the shared work folder.

Cluster deployments pass their own configuration (``spark-submit --conf``);
``get_session`` only fills in values that are not already set, so it never
overrides what the cluster operator chose.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults that matter for correctness (UTC) and for scale (AQE re-plans
# shuffle partition counts, converts joins to broadcast from *runtime* sizes,
# and splits skewed join partitions).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "probity",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    from pyspark import SparkConf

    submitted = SparkConf()  # values given by spark-submit / the cluster
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {k: v for k, v in DEFAULT_CONF.items() if not submitted.contains(k)}
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and written intermediates.

    Read from the session (``spark.checkpoint.dir``, which a cluster points at
    shared storage).  Only when it is unset -- local runs and tests -- a fresh
    folder under the system temp dir is created and registered.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="probity-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


_scopes: list[list[str]] = []


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    sep = "" if base.endswith("/") else "/"
    return made(f"{base}{sep}probity-work/{name}-{uuid.uuid4().hex[:12]}")


def made(path: str) -> str:
    """Note a folder of intermediates for the open scopes."""
    for scope in _scopes[-1:]:
        scope.append(path)
    return path


@contextmanager
def work_scope(spark: SparkSession):
    """Delete, at its end, every intermediate that operators wrote inside.

    A query's result is lazy and reads its intermediates, so write or read it inside:
    ``with work_scope(spark): query(spark, path).write.parquet(out)``.  A scope inside another
    deletes its own only.  Yields the list of folders."""
    mine: list[str] = []
    _scopes.append(mine)
    try:
        yield mine
    finally:
        _scopes.remove(mine)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in mine:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


__all__ = ["get_session", "checkpoint_dir", "work_dir", "work_scope", "made", "DEFAULT_CONF"]


def materialize(df, name: str):
    """Write ``df`` once as Parquet under the shared work folder and read it
    back.  Used for intermediates that several branches of one plan reuse
    (Spark cannot share an exchange between branches whose pruned columns
    differ); it also cuts the lineage, so a lost executor re-reads the files
    instead of recomputing the upstream shuffle."""
    path = work_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
