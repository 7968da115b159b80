"""Exact top-k inner products: ball trees with branch and bound, one per shard.

The rows are dealt into shards of about ``SHARD`` vectors; each shard is built into a
ball tree (split along the line between two far points, centre and radius per
node) and written as one row.  Queries travel in blocks of at most ``QUERIES``.  Each
task takes one block and a run of ``RUN`` shards: it visits the shards one after the
other and carries the block's k-th scores along, so a later shard prunes with
what the earlier ones found.  Within a tree the node of greater upper bound
(q.c + |q| r) is opened first; a node is left when its bound is below a query's
k-th score.  The runs' best k are merged per query.

A component x is floor(256 x), an integer; products are summed in float64, exact
below 2^53, and bounds are widened by a rounding margin, so scores and ties are
exact.  Vectors whose squares sum to 2^52 or more stay out of the trees: they meet
the queries in blocks, with sums of Python integers.  Ties go to the smaller vec_id.

Defined cases: vectors that are null, or hold a null or non-finite component, take
no part; vectors of another length than the query's are no candidates; rows that
share a query's vec_id are not its candidates; fewer than k candidates give all; a
score beyond a long takes its place by the exact sum and is shown as the nearest long.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probity.llm.common import Scratch

SHARD, LEAF, QUERIES, RUN = 2048, 64, 256, 8


def build(x: np.ndarray):
    """Ball tree over rows of x: (order, nodes); a node is (lo, hi, centre, radius, left, right)."""
    order, nodes = np.arange(len(x)), []

    def node(lo, hi):
        p = x[order[lo:hi]]
        c = p.mean(0)
        d = np.sqrt(((p - c) ** 2).sum(1))
        k = len(nodes)
        nodes.append([lo, hi, c, float(d.max()), -1, -1])
        if hi - lo > LEAF and d.max() > 0:
            a = p[int(d.argmax())]
            b = p[int(((p - a) ** 2).sum(1).argmax())]
            side = p @ (b - a)
            o = np.argsort(side, kind="stable")
            order[lo:hi] = order[lo:hi][o]
            mid = (lo + hi) // 2
            nodes[k][4] = node(lo, mid)
            nodes[k][5] = node(mid, hi)
        return k

    node(0, len(x))
    return order, nodes


class Best:
    """The k best (score, -id) of each query of a block."""

    def __init__(self, n, k):
        self.k = k
        self.s = np.full((n, k), -np.inf)
        self.i = np.full((n, k), np.iinfo(np.int64).max)

    def add(self, rows, scores, ids):
        s = np.concatenate([self.s[rows], scores], 1)
        i = np.concatenate([self.i[rows], np.broadcast_to(ids, scores.shape)], 1)
        i = np.where(np.isneginf(s), np.iinfo(np.int64).max, i)
        o = np.lexsort((i, -s), axis=1)[:, :self.k]
        self.s[rows] = np.take_along_axis(s, o, 1)
        self.i[rows] = np.take_along_axis(i, o, 1)

    def kth(self, rows):
        return self.s[rows, -1]


def search(tree, x, ids, q, qid, best: Best):
    """Visit one tree for a block of queries, the node of greater bound first."""
    order, nodes = tree
    norm = np.sqrt((q * q).sum(1))

    def bound(k, rows):
        _lo, _hi, c, r, _a, _b = nodes[k]
        top = q[rows] @ c + norm[rows] * r
        return top + 1e-9 * (np.abs(top) + norm[rows] * (r + np.abs(c).max())) + 1e-6

    def visit(k, rows, top):
        rows = rows[top >= best.kth(rows)]
        if not len(rows):
            return
        lo, hi, _c, _r, a, b = nodes[k]
        if a < 0:
            p = order[lo:hi]
            s = q[rows] @ x[p].T
            s[qid[rows][:, None] == ids[p][None, :]] = -np.inf
            best.add(rows, s, ids[p])
            return
        ta, tb = bound(a, rows), bound(b, rows)
        for child, t in ((a, ta), (b, tb)) if ta.max() >= tb.max() else ((b, tb), (a, ta)):
            visit(child, rows, t)

    rows = np.arange(len(q))
    visit(0, rows, bound(0, rows))


def _matrix(batch):
    ids = batch.column("vec_id").cast(pa.int64()).to_numpy(zero_copy_only=False)
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return ids, flat.reshape(len(ids), -1) if len(ids) else flat.reshape(0, 0)


def _pack(kind):
    """Rows of one dimension and shard (sorted) -> one row per shard or block."""
    def run(batches):
        key, ids, vs, seq = None, [], [], 0
        cap = SHARD if kind == "shard" else QUERIES

        def flush():
            i, x = np.array(ids, np.int64), np.stack(vs)
            blob = pickle.dumps((i, x, build(x) if kind == "shard" else None))
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()),
                                               pa.array([seq], pa.int32()), pa.array([blob], pa.binary())],
                                              names=["dim", "part", "seq", "blob"])

        for batch in batches:
            dim, part = batch.column("dim").to_pylist(), batch.column("part").to_pylist()
            vec, vid = batch.column("v"), batch.column("vec_id").to_pylist()
            off = np.asarray(vec.offsets)
            flat = vec.values.to_numpy(zero_copy_only=False).astype(np.float64)
            for r in range(batch.num_rows):
                k = (dim[r], part[r])
                if ids and (k != key or len(ids) >= cap):
                    yield flush()
                    seq = seq + 1 if k == key else 0
                    ids, vs = [], []
                key = k
                ids.append(vid[r])
                vs.append(flat[off[r]:off[r + 1]])
        if ids:
            yield flush()

    return run


def _visit(k):
    def run(batches):
        key, block, best = None, None, None

        def result():
            q, at = np.nonzero(~np.isneginf(best.s))
            return pa.RecordBatch.from_arrays(
                [pa.array(block[0][q]), pa.array(best.i[q, at]), pa.array(best.s[q, at].astype(np.int64))],
                names=["query_id", "vec_id", "score"])

        for batch in batches:
            for r in batch.to_pylist():
                new = (r["dim"], r["qpart"], r["qseq"], r["run"])
                if new != key:
                    if key:
                        yield result()
                    key, block = new, pickle.loads(r["qblob"])
                    best = Best(len(block[0]), k)
                ids, x, tree = pickle.loads(r["blob"])
                search(tree, x, ids, block[1], block[0], best)
        if key:
            yield result()

    return run


def quantised(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, dim, v): floor(256 x) of every usable vector."""
    c = F.col(vector)
    good = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return (rows.filter(c.isNotNull() & F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False)))
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.size(c).cast("int").alias("dim"),
                    F.transform(c, lambda x: _floor(x.cast("double") * 256)).alias("v")))


def _floor(x):
    """floor as a double; from 2^53 on a double is an integer already."""
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)


def _large(v):
    """Whether sums of products with this vector may need more than a double's 53 bits."""
    return F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x) >= 2.0**52


def _order(score):
    """A string that sorts as the integer does, whatever its length."""
    s = score.cast("string")
    digits = F.when(score < 0, F.substring(s, 2, 40)).otherwise(s)
    return _ordered(score < 0, digits)


def _ordered(negative, digits):
    n = F.length(digits)
    return F.when(negative, F.concat(F.lit("0"), F.lpad((99999 - n).cast("string"), 5, "0"), F.translate(digits, "0123456789", "9876543210"))
                  ).otherwise(F.concat(F.lit("1"), F.lpad(n.cast("string"), 5, "0"), digits))


def _exact(k):
    """Blocks of vectors with large components: sums of Python integers, the k best of each query."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                (qi, q, _), (ci, c, _) = pickle.loads(r["qblob"]), pickle.loads(r["blob"])
                q, c = ([[int(x) for x in v] for v in m] for m in (q, c))
                rows = []
                for i, a in zip(qi.tolist(), q):
                    got = sorted(((sum(x * y for x, y in zip(a, b)), j) for j, b in zip(ci.tolist(), c) if j != i), key=lambda x: (-x[0], x[1]))
                    rows += [(i, j, max(-(1 << 63), min((1 << 63) - 1, s)), s < 0, str(abs(s))) for s, j in got[:k]]
                cols = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x, pa.int64()) for x in cols[:3]), pa.array(cols[3], pa.bool_()), pa.array(cols[4], pa.string())],
                    names=["query_id", "vec_id", "score", "negative", "digits"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k greatest inner products of each query row.

    Both sides come from ``quantised``.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")

    vectors, queries = (d.withColumn("large", _large(F.col("v"))) for d in (vectors, queries))
    some = not vectors.filter("large").limit(1).isEmpty() or not queries.filter("large").limit(1).isEmpty()
    every, asked = vectors, queries
    if some:
        vectors, queries = vectors.filter("not large"), queries.filter("not large")

    def packed(df, kind, size):
        parts = max(1, -(-df.count() // size))
        blob = "dim int, part int, seq int, blob binary"
        dealt = df.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int"))
        return scratch.write(dealt.repartition(parts, "dim", "part").sortWithinPartitions("dim", "part", "vec_id")
                             .select("dim", "part", "vec_id", "v").mapInArrow(_pack(kind), blob))

    shards = packed(vectors, "shard", SHARD).withColumn("run", F.floor(F.col("part") / RUN).cast("int"))
    blocks = packed(queries, "block", QUERIES).select(
        "dim", F.col("part").alias("qpart"), F.col("seq").alias("qseq"), F.col("blob").alias("qblob"))
    # every block meets every shard: the stated query set against all rows, in blocks
    pairs = shards.join(blocks, "dim")
    found = (pairs.repartition("dim", "qpart", "qseq", "run")
             .sortWithinPartitions("dim", "qpart", "qseq", "run", "part", "seq")
             .select("dim", "qpart", "qseq", "run", "qblob", "blob")
             .mapInArrow(_visit(k), "query_id long, vec_id long, score long"))
    from pyspark.sql import Window
    order = F.desc("score")
    if some:
        # few rows, as a rule: large vectors against all queries, and large queries against the rest, exactly
        def meet(c, q):
            c, q = packed(c, "block", QUERIES), packed(q, "block", QUERIES).select("dim", F.col("blob").alias("qblob"))
            pairs = c.join(q, "dim").select("qblob", "blob").repartition(F.xxhash64("qblob", "blob"))
            return pairs.mapInArrow(_exact(k), "query_id long, vec_id long, score long, negative boolean, digits string").select(
                "query_id", "vec_id", "score", _ordered(F.col("negative"), F.col("digits")).alias("order"))

        more = meet(every.filter("large"), asked).union(meet(every.filter("not large"), asked.filter("large")))
        found = found.withColumn("order", _order(F.col("score"))).union(more)
        order = F.desc("order")
    w = Window.partitionBy("query_id").orderBy(order, "vec_id")
    return (found.withColumn("rank", F.row_number().over(w).cast("int")).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
