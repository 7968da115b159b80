"""MinHash near-duplicates: one-permutation hashing, optimal densification,
banded buckets, star-shaped candidate edges, exact confirmation.

Steps, all keyed by data and none by group size:

1. every text becomes its set of distinct 5-word shingles (64-bit hashes), a
   set id (two independent 64-bit sums), and band keys of one one-permutation
   signature: each shingle falls into one of ``BANDS * ROWS`` bins and the bin keeps
   its least value; an empty bin borrows from a bin picked by a 2-universal
   hash of (bin, attempt), the same for every document;
2. documents with equal sets collapse to the class of their least id, so a
   group of copies costs one row per copy and no pair;
3. classes meet in band buckets.  A bucket of n classes gives n - 1 edges to
   its least id (a star).  Edges seen in two bands or more join into candidate
   clusters: a first, cheap turn that keeps groups of near copies together;
4. classes of one cluster are compared on full sets, in square blocks of at
   most ``BLOCK`` classes a side, so a large cluster spreads over many tasks and is
   never in one.  Each block pair returns a spanning forest of its links, not
   its pairs;
5. buckets that hold classes of several clusters are paired across the clusters,
   whatever their hubs.  Pairs of possible sizes with two common buckets or more
   are compared on full sets, pair by pair;
6. the links' connected components are the answer, handed back to the members.

With 64 bands of 7 rows a pair at similarity 0.85 is in fewer than two common
buckets with probability below 1e-9 (at 0.8: 5e-6).  Every pair in two common
buckets is compared, in step 4 or 5, so this is the only loss.  Confirmed links are exact.

Defined cases: null or empty texts and texts without words have an empty set
and are linked with nothing; rows that share a doc_id are one node; a null
doc_id is returned with a null component and kept; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probity.llm import textcore as tc
from probity.llm.common import Scratch, components
from probity.operators.pairs import grid_join

BANDS, ROWS = 64, 7
BLOCK = 512
BROADCAST_ROWS = 1_000_000   # of 28 bytes each
SHINGLE = 5


def signature(h: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation minima of a non-empty set, densified."""
    v = tc.mix(h + np.uint64(0x5851F42D4C957F2D))
    b = ((v >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    sig = np.full(bins, np.uint64(2**64 - 1))
    order = np.argsort(v)[::-1]          # the least value of a bin is written last
    sig[b[order]] = v[order]
    filled = np.zeros(bins, bool)
    filled[b] = True
    empty = np.flatnonzero(~filled)
    attempt = 0
    out = sig.copy()
    while len(empty):
        attempt += 1
        pick = (tc.mix(empty.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt))
                % np.uint64(bins)).astype(np.int64)
        ok = filled[pick]
        out[empty[ok]] = sig[pick[ok]]
        empty = empty[~ok]
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    m = sig.reshape(BANDS, ROWS)
    acc = np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
    for j in range(ROWS):
        acc = tc.mix(acc ^ m[:, j])
    return acc.view(np.int64)


def _doc_sets(col):
    """Yield (first row, rows, offsets, hashes): distinct shingles of a slice of rows."""
    data, off = tc.column_bytes(col)
    for a, b in tc.row_slices(off):
        row, h = tc.shingles(*tc.scan(data, off[a:b + 1], tc.SPACED), SHINGLE)
        row, h = tc.distinct(row, h)
        yield a, b, np.searchsorted(row, np.arange(b - a + 1)), h


def _describe(batches):
    for batch in batches:
        n = batch.num_rows
        size, s1, s2 = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        bands = []
        for a, b, at, h in _doc_sets(batch.column("text")):
            g = tc.mix(h + np.uint64(0xABCDEF1234567))
            for i in range(b - a):
                x = h[at[i]:at[i + 1]]
                size[a + i] = len(x)
                if len(x):
                    s1[a + i] = x.sum(dtype=np.uint64).view(np.int64)
                    s2[a + i] = g[at[i]:at[i + 1]].sum(dtype=np.uint64).view(np.int64)
                    bands.append(band_keys(signature(x, BANDS * ROWS)))
        lens = np.where(size > 0, BANDS, 0)
        flat = np.concatenate(bands) if bands else np.zeros(0, np.int64)
        offs = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(size), pa.array(s1), pa.array(s2),
             pa.ListArray.from_arrays(pa.array(offs), pa.array(flat))],
            names=["doc_id", "n_shingles", "s1", "s2", "bands"])


def _linked(sets_a, sets_b, same: bool, num: int, den: int):
    """Pairs (i, j) with den * |A n B| >= num * |A u B|, by blocks of columns."""
    if not sets_a or not sets_b:
        return np.zeros((0, 2), np.int64)
    na = np.array([len(x) for x in sets_a], np.int64)
    nb = np.array([len(x) for x in sets_b], np.int64)
    rows_a, rows_b = np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)
    ha, hb = np.concatenate(sets_a), np.concatenate(sets_b)
    if same:
        vocab, inv, cnt = np.unique(ha, return_inverse=True, return_counts=True)
        vocab, use = vocab[cnt > 1], None
    else:
        vocab = np.intersect1d(ha, hb)
    inter = np.zeros((len(na), len(nb)), np.float32)
    ia, ib = np.searchsorted(vocab, ha), np.searchsorted(vocab, hb)
    ok_a = (ia < len(vocab)) & (vocab[np.minimum(ia, len(vocab) - 1)] == ha) if len(vocab) else np.zeros(len(ha), bool)
    ok_b = (ib < len(vocab)) & (vocab[np.minimum(ib, len(vocab) - 1)] == hb) if len(vocab) else np.zeros(len(hb), bool)
    ra, ia, rb, ib = rows_a[ok_a], ia[ok_a], rows_b[ok_b], ib[ok_b]
    if len(vocab) > 4096:
        oa, ob = np.argsort(ia, kind="stable"), np.argsort(ib, kind="stable")
        ra, ia, rb, ib = ra[oa], ia[oa], rb[ob], ib[ob]
    for lo in range(0, len(vocab), 4096):
        w = min(4096, len(vocab) - lo)
        sa = slice(*np.searchsorted(ia, [lo, lo + w])) if len(vocab) > 4096 else slice(None)
        sb = slice(*np.searchsorted(ib, [lo, lo + w])) if len(vocab) > 4096 else slice(None)
        ma, mb = np.zeros((len(na), w), np.float32), np.zeros((len(nb), w), np.float32)
        ma[ra[sa], ia[sa] - lo] = 1
        mb[rb[sb], ib[sb] - lo] = 1
        inter += ma @ mb.T
    both = inter.astype(np.int64)
    union = na[:, None] + nb[None, :] - both
    hit = den * both >= num * union
    if same:
        hit = np.triu(hit, 1)
    return np.argwhere(hit)


def _forest(ids_a, ids_b, pairs):
    """A spanning forest of the links, as (least id side first) edges."""
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in pairs:
        x, y = int(ids_a[i]), int(ids_b[j])
        rx, ry = find(x), find(y)
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            out.append((x, y))
    return out


def _compare(num: int, den: int):
    def run(batches):
        """A task's rows are sorted by (cluster, p, q): whole block pairs follow each other."""
        key, held = None, []

        def flush():
            rows = [r for r in held if r[0] == key[1]] if key else []
            cols = rows if key[1] == key[2] else [r for r in held if r[0] == key[2]]
            pairs = _linked([r[2] for r in rows], [r[2] for r in cols], key[1] == key[2], num, den)
            return _forest([r[1] for r in rows], [r[1] for r in cols], pairs)

        for batch in batches:
            out = []
            cl, p, q, blk, ids = (batch.column(c).to_pylist() for c in ("cluster", "p", "q", "blk", "doc_id"))
            for a, b, at, h in _doc_sets(batch.column("text")):
                for i in range(a, b):
                    k = (cl[i], p[i], q[i])
                    if k != key:
                        if held:
                            out += flush()
                        key, held = k, []
                    held.append((blk[i], ids[i], h[at[i - a]:at[i - a + 1]].copy()))
            yield _edges(out)
        if held:
            yield _edges(flush())

    return run


def _edges(pairs):
    return pa.RecordBatch.from_arrays(
        [pa.array([x for x, _ in pairs], pa.int64()), pa.array([y for _, y in pairs], pa.int64())], names=["a", "b"])


def _set_rows(batches):
    for batch in batches:
        for a, b, at, h in _doc_sets(batch.column("text")):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(a, b - a),
                 pa.ListArray.from_arrays(pa.array(np.append(at, len(h)).astype(np.int32)[:b - a + 1]), pa.array(h.view(np.int64)))],
                names=["doc_id", "words"])


def _across(base: DataFrame, met: DataFrame, cluster: DataFrame, num: int, den: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) between clusters: pairs with two common buckets or more, compared on full sets.

    ``met``: (rep, n, band) of the buckets of several classes.
    """
    spread = scratch.write(met.join(cluster, "rep", "left").select(
        "band", "rep", "n", F.coalesce("cluster", "rep").alias("grp")))
    mixed = spread.groupBy("band").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi")).filter("lo < hi").select("band")
    mixed = scratch.write(spread.join(mixed, "band"))
    left = mixed.toDF("band", "a", "na", "ga")
    right = mixed.toDF("band", "b", "nb", "gb")
    apart = (F.col("a") < F.col("b")) & (F.col("ga") != F.col("gb")) & (
        F.least("na", "nb") * den >= F.greatest("na", "nb") * num)
    pairs = scratch.write(grid_join(left, right, ["band"], F.col("a"), F.col("b"), apart, self_join=True)
                          .groupBy("a", "b").count().filter("count >= 2").select("a", "b"))
    ends = scratch.write(pairs.select(F.col("a").alias("d")).union(pairs.select("b")).distinct())
    small = ends.count() <= BROADCAST_ROWS
    sets = scratch.write(base.join(F.broadcast(ends) if small else ends, base.doc_id == ends.d).select("doc_id", "text")
                         .mapInArrow(_set_rows, "doc_id long, words array<long>"))
    both = F.size(F.array_intersect("wa", "wb"))
    return (pairs.join(sets.toDF("a", "wa"), "a").join(sets.toDF("b", "wb"), "b")
            .filter(den * both >= num * (F.size("wa") + F.size("wb") - both)).select("a", "b"))


def near_duplicates(docs: DataFrame, num: int = 85, den: int = 100, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Documents are linked when ``den * |A n B| >= num * |A u B|``.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "minhash")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = scratch.write(base.mapInArrow(
        _describe, "doc_id long, n_shingles long, s1 long, s2 long, bands array<long>"))

    key = ["n_shingles", "s1", "s2"]
    classes = scratch.write(sets.filter("n_shingles > 0 and doc_id is not null").groupBy(*key)
                            .agg(F.min("doc_id").alias("rep")))
    reps = sets.filter("n_shingles > 0").join(
        classes.select(*[F.col(c).alias(f"c_{c}") for c in key], "rep"),
        (F.col("doc_id") == F.col("rep")) & (F.col("n_shingles") == F.col("c_n_shingles"))
        & (F.col("s1") == F.col("c_s1")) & (F.col("s2") == F.col("c_s2")))
    keyed = reps.select("rep", F.col("n_shingles").alias("n"), F.explode("bands").alias("band"))
    hubs = keyed.groupBy("band").agg(F.min("rep").alias("hub"), F.max("rep").alias("top")).filter("hub < top")
    met = scratch.write(keyed.join(hubs.select("band", "hub"), "band").select("rep", "n", "band", "hub"))
    star = (met.filter("rep <> hub")
            .groupBy("rep", "hub").count().filter("count >= 2").select(F.col("rep").alias("a"), F.col("hub").alias("b")))
    comp = components(spark, star, scratch)
    cluster = scratch.write(comp.union(comp.select("root", "root")).distinct().toDF("rep", "cluster"))

    size = cluster.groupBy("cluster").agg(F.count("*").alias("m"))
    placed = (cluster.join(size, "cluster")
              .withColumn("nb", F.ceil(F.col("m") / BLOCK).cast("int"))
              .withColumn("blk", F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int"))
              .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
              .select("rep", "cluster", "blk", F.least("blk", "o").alias("p"), F.greatest("blk", "o").alias("q")))
    placed = scratch.write(placed)
    small = placed.count() <= BROADCAST_ROWS      # else the texts are shuffled to them
    member = base.join(F.broadcast(placed) if small else placed, base.doc_id == placed.rep).select("cluster", "p", "q", "blk", "doc_id", "text")
    links = scratch.write(
        member.repartition("cluster", "p", "q").sortWithinPartitions("cluster", "p", "q", "doc_id")
        .mapInArrow(_compare(num, den), "a long, b long"))
    links = scratch.write(links.union(_across(base, met.drop("hub"), cluster, num, den, scratch)))
    linked = components(spark, links, scratch).toDF("rep", "root")

    named = classes.join(linked, "rep", "left").select(*key, F.coalesce("root", "rep").alias("root"))
    out = sets.select("doc_id", *key).join(named, key, "left")
    comp_id = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("root", "doc_id"))
    return out.select("doc_id", "n_shingles", comp_id.alias("component_id"),
                      F.coalesce(F.col("doc_id") == comp_id, F.lit(True)).alias("kept"))


__all__ = ["near_duplicates", "signature", "band_keys"]
