"""Whitening components of embeddings by shifted CholeskyQR.

The distinct quantised vectors are centred on their exact integer sums and form
the rows of a tall matrix A.  Each pass multiplies the rows A R1^-1 ... Rk^-1,
found by triangular solves inside the tasks, with themselves (a Gram matrix of
the vectors' length squared, summed over partitions), and factors that matrix by
Cholesky.  The first factor is shifted, so it exists for any condition number;
passes go on until the rows are orthonormal.  A = Q (Rk ... R1), so the singular
values and right vectors of the composed R are those of A: component vectors and
n times the eigenvalues of the covariance.

Scale: one distinct over the vectors, after which every pass reads the written
fit list once and sends one small matrix a partition, summed in at most
``GROUPS`` groups; only those reach the driver.

Defined cases: a vector that is null, or holds a null, a non-finite entry or one
beyond 2^50 (its quantised value is no long), is left out; vectors of different
lengths are fitted apart, each length on its own; repeated rows and ids give
repeated results and count once in the fit; directions without variance have no
component, so one distinct vector, or an empty table, gives no rows; a
``deviation`` beyond a long is null; a null vec_id is kept; other columns are
not read.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probity.llm.common import Scratch

SCALE, OFFSET, TOP = 64, 1_000_000, 16
GROUPS, PASSES = 64, 12
LARGEST = float(1 << 50)
#: share of a unit direction below which a Gram eigenvalue stands for no variance
NOTHING = 1e-12
SCHEMA = ("component int, n long, deviation long, whitened double, explained double, identity_error double")


def quantised(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(key, x): floor(64 c) + 1000000 of each entry, without the rows left out."""
    v = F.col(column)
    fits = lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False)) & ~F.isnan(c)
    x = F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + F.lit(OFFSET).cast("long"))
    return vectors.filter(v.isNotNull() & F.forall(v, fits)).select(key, x.alias("x"))


def _matrix(batch, d: int) -> np.ndarray:
    """The x column of a batch as rows of ``d`` integers."""
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _summed(rows: DataFrame, run, add) -> list:
    """``run`` makes one JSON text a partition, ``add`` joins a list of them."""
    def together(batches):
        texts = [json.loads(t) for b in batches for t in b.column("t").to_pylist()]
        if texts:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([json.dumps(add(texts))])], names=["g", "t"])

    def mine(batches):
        got = run(batches)
        if got is not None:
            g = TaskContext.get().partitionId() % GROUPS
            yield pa.RecordBatch.from_arrays([pa.array([g], pa.int32()), pa.array([json.dumps(got)])], names=["g", "t"])

    parts = rows.mapInArrow(mine, "g int, t string").repartition("g").mapInArrow(together, "g int, t string")
    return [json.loads(r["t"]) for r in parts.collect()]       # GROUPS rows at most


def sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and their exact sums by dimension."""
    def run(batches):
        n, total = 0, [0] * d
        for b in batches:
            x = _matrix(b, d)
            high, low = (x >> 24).sum(0), (x & 0xFFFFFF).sum(0)
            total = [t + (int(h) << 24) + int(lo) for t, h, lo in zip(total, high, low)]
            n += len(x)
        return [n, *total] if n else None

    add = lambda rows: [sum(c) for c in zip(*rows)]
    got = add(_summed(fit, run, add)) or [0] * (d + 1)
    return got[0], got[1:]


class Centre:
    """x - S / n without cancellation: the integer part first, then the rest."""

    def __init__(self, n: int, s: list[int]):
        self.n, self.s = n, s
        self.whole = [(2 * v + n) // (2 * n) for v in s]
        self.rest = [v - n * w for v, w in zip(s, self.whole)]
        self.part = np.array([r / n for r in self.rest])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array(self.whole, np.int64)).astype(np.float64) - self.part

    def deviation(self, x: np.ndarray) -> list:
        """Sum over dimensions of (n x - S)^2, exact; None beyond a long."""
        near = x - np.array(self.whole, np.int64)
        rest = max(map(abs, self.rest), default=0)
        largest = self.n * int(np.abs(near).max(initial=0)) + rest
        if largest * largest * max(1, x.shape[1]) < 1 << 63:
            return ((near * self.n - np.array(self.rest, np.int64)) ** 2).sum(1).tolist()
        rows = [sum((self.n * v - r) ** 2 for v, r in zip(row, self.rest)) for row in near.tolist()]
        return [v if v < 1 << 63 else None for v in rows]


def solve(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q with Q R = A, column by column; R upper triangular.  A tall R stands for a projection."""
    if r.shape[0] != r.shape[1] or np.any(np.tril(r, -1)):
        return a @ r.T
    q = np.empty_like(a)
    for j in range(a.shape[1]):
        q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def gram(fit: DataFrame, d: int, change) -> np.ndarray:
    """Sum of outer products of the changed rows."""
    def run(batches):
        total = None
        for b in batches:
            q = change(_matrix(b, d))
            total = q.T @ q + (0 if total is None else total)
        return None if total is None else total.tolist()

    add = lambda parts: np.sum(np.array(parts), 0).tolist()
    return np.array(add(_summed(fit, run, add)))


def factor(fit: DataFrame, d: int, centre: Centre) -> np.ndarray:
    """R with R'R = A'A for the centred rows A, in as many passes as orthonormal rows need."""
    steps: list[np.ndarray] = []
    unit = np.finfo(float).eps / 2

    def change(x):
        a = centre(x)
        for r in steps:
            a = solve(a, r)
        return a

    whole = np.eye(d)
    for k in range(PASSES):
        g = gram(fit, d, change)
        ev, vec = np.linalg.eigh(g)
        if k == 0 and not np.trace(g) > 0:
            return np.zeros((0, d))
        if k == 1 and ev[0] < NOTHING:                 # directions without variance go, once
            keep = vec[:, ev >= NOTHING].T
            steps.append(keep)
            whole, g = keep @ whole, keep @ g @ keep.T
            ev = np.linalg.eigvalsh(g)
        if k and np.abs(ev - 1).max() < 1e-10:
            break
        m = len(g)
        shift = 11 * (centre.n * m + m * (m + 1)) * unit * np.trace(g) if k == 0 or ev[0] < 0.1 else 0.0
        r = np.linalg.cholesky(g + shift * np.eye(m)).T
        steps.append(r)
        whole = r @ whole
    ev, vec = np.linalg.eigh(g)                        # what the last rows lack of orthonormal
    return (vec * np.sqrt(np.maximum(ev, 0))) @ vec.T @ whole


def components(fit: DataFrame, d: int, top: int = TOP):
    """(centre, vectors, eigenvalues, explained) of the fit list's covariance."""
    n, s = sums(fit, d)
    centre = Centre(n, s)
    r = factor(fit, d, centre)
    if not len(r):
        return centre, np.zeros((0, d)), np.zeros(0), np.zeros(0)
    _, sigma, v = np.linalg.svd(r, full_matrices=False)
    e = sigma ** 2 / n
    k = min(top, len(e))
    return centre, v[:k], e[:k], e[:k] / e.sum()


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", top: int = TOP) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): one row per
    vector and component, largest variance first."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "whiten")
    every = quantised(vectors, key, column)
    kind = every.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, {SCHEMA}"
    fit = scratch.write(every.select("x").distinct())
    lengths = [r[0] for r in fit.select(F.size("x").alias("d")).distinct().collect() if r[0]]
    out = spark.createDataFrame([], schema)
    for d in sorted(lengths):                          # one, unless vectors of several models are mixed
        mine = fit.filter(F.size("x") == d) if len(lengths) > 1 else fit
        centre, v, e, explained = components(mine, d, top)
        if not len(v):
            continue
        to = (v / np.sqrt(e)[:, None]).T
        error = float(np.abs(gram(mine, d, lambda x: centre(x) @ to) / centre.n - np.eye(len(e))).max())  # noqa: B023
        part = every.filter(F.size("x") == d).mapInArrow(_output(key, d, centre, to, explained, error), schema)
        out = part if len(lengths) == 1 else out.union(part)
    return out


def _output(key, d, centre, to, explained, error):
    k = to.shape[1]

    def run(batches):
        for b in batches:
            x = _matrix(b, d)
            rows = len(x)
            which = np.repeat(np.arange(rows), k)
            deviation = pa.array(centre.deviation(x), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(key).take(pa.array(which)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                 pa.array(np.full(rows * k, centre.n)), deviation.take(pa.array(which)),
                 pa.array((centre(x) @ to).ravel()), pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error))],
                names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run
