"""Per-batch results kept as a few sorted-out folders instead of one folder a batch.

``Runs`` is a log of folders, each the result of a range of micro-batches.  A new
batch writes a run of level 0; ``FAN`` runs of a level are merged into one of the
next, so n batches leave at most ``FAN - 1`` folders a level and log_FAN(n) levels,
and a row is rewritten once a level.

Safe to repeat: a batch merges runs of earlier batches only, which the stream has
committed by then, so a replayed batch finds its own run apart and overwrites it.  A
merged run counts once its ``_SUCCESS`` file is there; runs it covers are ignored from
then on and deleted, so a stop in between leaves nothing double.

``KeyIndex`` lists the keys of a table in such runs.  A run has as many buckets as
its key count asks for, and a Bloom filter as rows (word, bits): each key sets four
bits of one 64-bit word, with ``WORD_KEYS`` keys a word on average.  A batch joins its keys to
the words, and reads only the buckets in which some key may be.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FAN = 8
BUCKET_KEYS = 1 << 16
WORD_KEYS = 2


def hadoop(spark: SparkSession, path: str):
    """(file system, path) of a location that executors share."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = hadoop(spark, path)
    fs.delete(p, True)


@dataclass(frozen=True)
class Run:
    level: int
    first: int
    last: int
    note: str
    path: str

    def holds(self, other: "Run") -> bool:
        return other.level < self.level and self.first <= other.first and other.last <= self.last


class Runs:
    """The runs under ``root``; ``note`` is what a reader must know of a run, in its name."""

    def __init__(self, spark: SparkSession, root: str, fan: int = FAN):
        self.spark, self.root, self.fan = spark, root, fan

    def all(self) -> list[Run]:
        """Finished runs, oldest first, without those that a merged run covers."""
        fs, root = hadoop(self.spark, self.root)
        if not fs.exists(root):
            return []
        found = []
        for s in fs.listStatus(root):
            name = s.getPath().getName()
            path = f"{self.root}/{name}"
            if name.startswith("L") and exists(self.spark, f"{path}/_SUCCESS"):
                level, first, last, note = name[1:].split("-", 3)
                found.append(Run(int(level), int(first), int(last), note, path))
        live = [r for r in found if not any(o.holds(r) for o in found)]
        return sorted(live, key=lambda r: (r.first, -r.level))

    def before(self, batch: int) -> list[Run]:
        return [r for r in self.all() if r.last < batch]

    def own(self, batch: int) -> list[Run]:
        return [r for r in self.all() if r.level == 0 and r.first == batch]

    def path(self, level: int, first: int, last: int, note: str = "") -> str:
        return f"{self.root}/L{level}-{first:012d}-{last:012d}-{note}"

    def put(self, rows: DataFrame, batch: int, note: str = "") -> str:
        """Write the run of a batch, in place of what an earlier attempt left."""
        for r in self.own(batch):
            delete(self.spark, r.path)
        path = self.path(0, batch, batch, note)
        rows.write.mode("overwrite").parquet(path)
        return path

    def merge(self, batch: int, write: Callable[[list[Run], int], None]) -> None:
        """Merge levels that are full, of runs before ``batch``; ``write(runs, level)`` writes the new run."""
        level = 0
        while True:
            runs = self.before(batch)
            if level > max((r.level for r in runs), default=-1):
                break
            mine = [r for r in runs if r.level == level]
            if len(mine) >= self.fan:
                write(mine, level + 1)
                for r in mine:
                    delete(self.spark, r.path)
            level += 1


class Sums:
    """Additive aggregates by key, kept in runs and added up on read."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], sums: list[str], most: list[str] = (), fan: int = FAN):
        self.runs, self.keys, self.sums, self.most = Runs(spark, root, fan), list(keys), list(sums), list(most)

    def add(self, rows: DataFrame, batch: int, live=None) -> None:
        """The sums of a batch; ``live`` is a condition that rows must meet to be merged on."""
        def write(runs, level):
            path = self.runs.path(level, runs[0].first, runs[-1].last)
            old = self._added([r.path for r in runs])
            (old if live is None else old.filter(live)).write.mode("overwrite").parquet(path)

        self.runs.merge(batch, write)
        self.runs.put(rows, batch)

    def _added(self, paths: list[str]) -> DataFrame:
        one = self.runs.spark.read.parquet(paths[0]).schema          # the runs of a log share it
        df = self.runs.spark.read.schema(one).parquet(*paths)
        aggs = [F.sum(c).cast(one[c].dataType).alias(c) for c in self.sums] + [F.max(c).alias(c) for c in self.most]
        return df.groupBy(*self.keys).agg(*aggs)

    def total(self) -> DataFrame | None:
        """The current sums; None before the first batch."""
        paths = [r.path for r in self.runs.all()]
        return self._added(paths) if paths else None


class Log:
    """Rows kept in runs: merging joins small files, and drops rows that are no longer live."""

    def __init__(self, spark: SparkSession, root: str, fan: int = FAN):
        self.runs = Runs(spark, root, fan)

    def add(self, rows: DataFrame, batch: int, live=None) -> None:
        def write(runs, level):
            old = self._read(runs)
            path = self.runs.path(level, runs[0].first, runs[-1].last)
            (old if live is None else old.filter(live)).coalesce(len(runs)).write.mode("overwrite").parquet(path)

        self.runs.merge(batch, write)
        self.runs.put(rows, batch)

    def _read(self, runs: list[Run]) -> DataFrame | None:
        spark = self.runs.spark
        return spark.read.schema(spark.read.parquet(runs[0].path).schema).parquet(*[r.path for r in runs]) if runs else None

    def rows(self, before: int | None = None) -> DataFrame | None:
        """All rows, or those of batches before ``before``; None if there is no batch."""
        return self._read(self.runs.all() if before is None else self.runs.before(before))


def _hashes(key: str):
    """What a run stores of a key: the hash that picks its bucket and bits, and the one that picks its word."""
    h = F.xxhash64(key)
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright("h", 8 * k).bitwiseAND(F.lit(63)).cast("int"))
            for k in range(1, 5)]
    mask = bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])
    return h.alias("h"), F.xxhash64(F.lit(1), key).alias("g"), mask.alias("mask")


class KeyIndex:
    """The keys that a table holds, by run; see the module text."""

    def __init__(self, spark: SparkSession, root: str, key: str, fan: int = FAN, bucket_keys: int = BUCKET_KEYS):
        self.spark, self.key, self.bucket_keys = spark, key, bucket_keys
        self.runs = Runs(spark, root, fan)

    def _write(self, keys: DataFrame, n: int, level: int, first: int, last: int) -> None:
        """The Bloom words, then the key buckets; the run counts when ``_SUCCESS`` of the second is there."""
        buckets, words = max(1, -(-n // self.bucket_keys)), max(1, -(-n // WORD_KEYS))
        path = self.runs.path(level, first, last, f"{buckets}-{words}")
        h, g, mask = _hashes(self.key)
        rows = keys.select(self.key, h, g).select(self.key, "h", "g", mask)
        (rows.groupBy(F.pmod("g", F.lit(words)).alias("word")).agg(F.bit_or("mask").alias("bits"))
         .withColumn("run", F.lit(f"{level}-{first}")).write.mode("overwrite").parquet(f"{path}/_bloom"))
        bucket = F.pmod("h", F.lit(buckets)).cast("int")
        out = rows.select(self.key, bucket.alias("bucket"))
        out = out.repartition(buckets, "bucket") if buckets > 1 else out.coalesce(1)   # one file a bucket
        for b in self.runs.own(first) if level == 0 else []:
            delete(self.spark, b.path)
        out.write.mode("append").partitionBy("bucket").parquet(path)

    def add(self, keys: DataFrame, n: int, batch: int) -> None:
        """List the ``n`` new keys of a batch."""
        for r in self.runs.own(batch):
            delete(self.spark, r.path)
        self._write(keys, n, 0, batch, batch)

    def compact(self, batch: int) -> None:
        """Merge full levels of earlier batches."""
        def write(runs, level):
            keys = self.spark.read.option("recursiveFileLookup", "true").parquet(*[r.path for r in runs]).select(self.key)
            self._write(keys, keys.count(), level, runs[0].first, runs[-1].last)

        self.runs.merge(batch, write)

    def buckets_to_read(self, keys: DataFrame, batch: int) -> list[str]:
        """Folders of the buckets of earlier batches in which a key of ``keys`` may be.

        Comes to the driver: at most one row a bucket."""
        runs = self.runs.before(batch)
        if not runs:
            return []
        shape = {f"{r.level}-{r.first}": (r.path, *map(int, r.note.split("-"))) for r in runs}
        every = F.array(*[F.struct(F.lit(k).alias("run"), F.lit(v[1]).alias("buckets"), F.lit(v[2]).alias("words"))
                          for k, v in shape.items()])
        h, g, mask = _hashes(self.key)
        probes = (keys.select(self.key, h, g).select("h", "g", mask, F.explode(every).alias("r"))
                  .select("r.run", F.pmod("h", "r.buckets").cast("int").alias("bucket"), F.pmod("g", "r.words").alias("word"), "mask"))
        schema = "word long, bits long, run string"
        words = self.spark.read.schema(schema).parquet(*[f"{v[0]}/_bloom" for v in shape.values()])
        hit = probes.join(words, ["run", "word"]).filter(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
        return [f"{shape[r['run']][0]}/bucket={r['bucket']}" for r in hit.select("run", "bucket").distinct().collect()]

    def known(self, keys: DataFrame, batch: int) -> DataFrame | None:
        """Keys of earlier batches, from the buckets that may hold one of ``keys``; None if none may."""
        paths = self.buckets_to_read(keys, batch)
        return self.spark.read.schema(keys.select(self.key).schema).parquet(*paths) if paths else None
