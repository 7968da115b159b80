"""Published tables: complete versions, and a pointer that says which one is current.

A version is a folder of its own, never written over.  Publishing it creates one empty
file in ``_current`` whose name is its number and its version; a file is there or not,
so a reader sees the old version or the new one.  The number only grows, and a
second writer of the same number fails.  A reader that resolved a version keeps its files: a
version goes when ``keep`` newer ones are published.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from probity.streaming.runs import delete, exists, hadoop


class Published:
    def __init__(self, spark: SparkSession, root: str, keep: int = 2):
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep

    def _pointers(self) -> list[tuple[int, str]]:
        fs, p = hadoop(self.spark, f"{self.root}/_current")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted((int(n.split("--", 1)[0]), n.split("--", 1)[1]) for n in names if "--" in n)

    def current(self) -> str | None:
        """Folder of the current version; None before the first."""
        at = self._pointers()
        return f"{self.root}/{at[-1][1]}" if at else None

    def point(self, version: str) -> None:
        """Make a complete version the current one (again, after a retry: no change)."""
        at = self._pointers()
        if at and at[-1][1] == version:
            return
        if not exists(self.spark, f"{self.root}/{version}/_SUCCESS"):
            raise ValueError(f"version {version} is not complete")
        number = at[-1][0] + 1 if at else 1
        fs, p = hadoop(self.spark, f"{self.root}/_current/{number:012d}--{version}")
        if any(n == number for n, _ in self._pointers()) or not fs.createNewFile(p):
            raise RuntimeError(f"another writer published number {number}")
        self.expire()

    def publish(self, df: DataFrame, version: str | None = None, fmt: str = "parquet") -> str:
        """Write ``df`` as a version and make it current.  A complete version is not written again."""
        version = version or f"v-{uuid.uuid4().hex[:12]}"
        path = f"{self.root}/{version}"
        if not exists(self.spark, f"{path}/_SUCCESS"):
            df.write.mode("overwrite").format(fmt).save(path)
        self.point(version)
        return path

    def expire(self) -> None:
        """Delete versions with at least ``keep`` newer ones; their pointers go first."""
        at = self._pointers()
        for n, version in at[:-1 - self.keep]:
            delete(self.spark, f"{self.root}/_current/{n:012d}--{version}")
            if version not in [v for _, v in at[-1 - self.keep:]]:
                delete(self.spark, f"{self.root}/{version}")

    def read(self, fmt: str = "parquet") -> DataFrame:
        path = self.current()
        if path is None:
            raise FileNotFoundError(f"nothing is published at {self.root}")
        return self.spark.read.format(fmt).load(path)
