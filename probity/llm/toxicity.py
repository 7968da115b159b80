"""Toxicity by a classifier chain.

Categories are predicted one after the other, and each later linear model also
reads the earlier categories' probabilities.  In training those come from models
that did not see the row (out of fold), so the chain learns from inputs like the
ones it gets later.

Features are the words of a text and their first 4, 5 and 6 bytes (hashed to 64
bits), present or not.  The ``FEATURES`` with the greatest chi-square against the
last category are kept.  The models are fitted on a bounded sample of labelled
rows: about ``SAMPLE`` of them, chosen by a hash of doc_id.  Scoring covers every
document and the whole text in one pass without a shuffle.

Categories (in chain order): ``insult`` and ``contempt`` are toxic rows that hold one
of the listed words, ``toxic`` is the label itself.

Defined cases: a null or empty text has no features and so the intercepts'
probabilities; labels that are null are not learned from, several labels of
one doc_id count as the greatest; without a positive and a negative label
every probability is 0 and nothing is toxic; columns are carried as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probity.llm import textcore as tc

SAMPLE = 24_000
FEATURES = 4096
FOLDS = 3
PREFIXES = (4, 5, 6)
CUT = (0.1, 0.9)             # the decision threshold is fitted within this range
# Words that make a toxic row one of the first two categories.
INSULT = ("idiot", "moron", "loser", "clown", "scum", "stupid")
CONTEMPT = ("trash", "pathetic", "worthless", "disgusting")
CATEGORIES = ("insult", "contempt", "toxic")


def _word_hash(words):
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    return tc.scan(data, np.array([0, len(data)]), tc.ALNUM)[1]


def _features(col):
    """Yield (first row, last row, row, feature) with distinct features of each row."""
    data, off = tc.column_bytes(col)
    for a, b in tc.row_slices(off):
        row, *hashes = tc.scan(data, off[a:b + 1], tc.ALNUM, PREFIXES)
        yield a, b, row, hashes


def _sampled(batches):
    """(feature, positives, negatives) of a task's labelled rows."""
    parts = []
    for batch in batches:
        y = np.asarray(batch.column("toxic").to_pylist(), bool)
        for a, _b, row, hashes in _features(batch.column("text")):
            for h in hashes:
                r, x = tc.distinct(row[h != 0], h[h != 0])
                parts.append((x, y[a:][r]))
    if parts:
        x, y = (np.concatenate(z) for z in zip(*parts))
        f, inv = np.unique(x, return_inverse=True)
        n, p = np.bincount(inv), np.bincount(inv, weights=y).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(f.view(np.int64)), pa.array(p), pa.array(n - p)],
                                         names=["f", "pos", "neg"])


class Lookup:
    """Feature hash -> index, with a bit table in front of the binary search."""

    def __init__(self, feats: np.ndarray):
        self.order = np.argsort(feats)
        self.sorted = feats[self.order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(feats & np.uint64(0xFFFFF)).astype(np.int64)] = True

    def __call__(self, row, h):
        ok = self.maybe[(h & np.uint64(0xFFFFF)).astype(np.int64)]
        row, h = row[ok], h[ok]
        if not len(self.sorted):
            return row[:0], np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
        ok = self.sorted[at] == h
        return row[ok], self.order[at[ok]]


def _encode(lookup, row, hashes, n):
    """Distinct (row, feature index) pairs."""
    rs, fs = zip(*(lookup(row, h) for h in hashes))
    key = np.unique(np.concatenate(rs).astype(np.int64) * FEATURES + np.concatenate(fs))
    return key // FEATURES, key % FEATURES


def _vectors(feats):
    def run(batches):
        lookup = Lookup(feats)
        insult, contempt = _word_hash(INSULT), _word_hash(CONTEMPT)
        for batch in batches:
            n = batch.num_rows
            idx, marks = [[] for _ in range(n)], np.zeros((n, 2), bool)
            for a, b, row, hashes in _features(batch.column("text")):
                r, f = _encode(lookup, row, hashes, b - a)
                cut = np.searchsorted(r, np.arange(b - a + 1))
                for i in range(b - a):
                    idx[a + i] = f[cut[i]:cut[i + 1]].tolist()
                for k, words in enumerate((insult, contempt)):
                    marks[a + row[np.isin(hashes[0], words)], k] = True
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("toxic").cast(pa.int32()),
                 pa.array(marks[:, 0]), pa.array(marks[:, 1]), pa.array(idx, pa.list_(pa.int32()))],
                names=["doc_id", "toxic", "insult", "contempt", "idx"])

    return run


class Logistic:
    """L2-regularised logistic regression on sparse binary features and a few dense ones."""

    def fit(self, rows, cols, n, dense, y, steps=150, rate=0.2, l2=2e-5):
        k = FEATURES + dense.shape[1] + 1
        w, m, v = np.zeros(k), np.zeros(k), np.zeros(k)
        pos = max(float(y.mean()), 1e-6) if n else 1e-6
        w[-1] = np.log(pos / max(1 - pos, 1e-6))
        for t in range(1, steps + 1):
            self.w = w
            g = (1 / (1 + np.exp(-self.raw(rows, cols, n, dense))) - y) / max(n, 1)
            grad = np.concatenate([np.bincount(cols, g[rows], FEATURES), dense.T @ g, [g.sum()]]) + l2 * w
            m = 0.9 * m + 0.1 * grad
            v = 0.99 * v + 0.01 * grad * grad
            w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        self.w = w
        return self

    def raw(self, rows, cols, n, dense):
        d = dense.shape[1]
        z = np.bincount(rows, self.w[cols], n) + self.w[-1]
        return np.clip(z + dense @ self.w[FEATURES:FEATURES + d], -30, 30)

    def proba(self, rows, cols, n, dense):
        return 1 / (1 + np.exp(-self.raw(rows, cols, n, dense)))


class Chain:
    """One model per category; a later one reads the earlier probabilities."""

    def __init__(self, feats=None):
        self.feats = np.zeros(0, np.uint64) if feats is None else feats
        self.models: list[Logistic] = []
        self.cut, self.oof = 2.0, None

    def fit(self, ids, rows, cols, ys):
        n = len(ids)
        fold = (tc.mix(ids.astype(np.uint64)) % np.uint64(FOLDS)).astype(np.int64)
        dense = np.zeros((n, 0))
        for y in ys:
            oof = np.zeros(n)
            for k in range(FOLDS):
                train = fold != k
                new = np.cumsum(train) - 1
                e = train[rows]
                model = Logistic().fit(new[rows[e]], cols[e], int(train.sum()), dense[train], y[train])
                oof[~train] = model.proba(rows, cols, n, dense)[~train]
            self.models.append(Logistic().fit(rows, cols, n, dense, y))
            dense = np.column_stack([dense, oof])
        order = np.argsort(-oof, kind="stable")
        hit = np.cumsum(ys[-1][order])
        f1 = 2 * hit / (np.arange(1, n + 1) + max(hit[-1], 1))
        k = int(np.argmax(f1))
        below = oof[order[k + 1]] if k + 1 < n else 0.0
        self.cut = float(np.clip((oof[order[k]] + below) / 2, *CUT))
        self.oof = float(f1[k])
        return self

    def proba(self, rows, cols, n):
        dense = np.zeros((n, 0))
        for model in self.models:
            dense = np.column_stack([dense, model.proba(rows, cols, n, dense)])
        return dense if self.models else np.zeros((n, len(CATEGORIES)))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain:
    """Fit the chain on about ``sample`` labelled rows of ``docs``."""
    y = (labels.filter("toxic is not null and doc_id is not null")
         .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    total = y.count()
    if total > sample:
        y = y.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(int(1_000_000 * sample / total)))
    # about ``sample`` rows of 12 bytes by construction
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(y), "doc_id")
    stats = chosen.mapInArrow(_sampled, "f long, pos long, neg long").groupBy("f").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).filter("pos + neg >= 2")
    n = y.groupBy().agg(F.sum("toxic").alias("p"), F.count("*").alias("n")).first()
    p, q = float(n["p"] or 0), float((n["n"] or 0) - (n["p"] or 0))
    if not p or not q:
        return Chain()
    a, b = F.col("pos"), F.col("neg")
    chi = (F.lit(p + q) * F.pow(a * (q - b) - b * (p - a), 2)
           / ((a + b) * (p + q - a - b + 1) * F.lit(p * q)))
    top = stats.select("f", chi.alias("chi")).orderBy(F.desc("chi"), "f").limit(FEATURES).collect()
    feats = np.array([r["f"] for r in top], np.int64).view(np.uint64)
    rows = chosen.mapInArrow(
        _vectors(feats), "doc_id long, toxic int, insult boolean, contempt boolean, idx array<int>").toPandas()
    rows = rows.sort_values("doc_id", kind="stable").reset_index(drop=True)
    lens = rows["idx"].map(len).to_numpy()
    cols = np.concatenate([*rows["idx"], np.zeros(0)]).astype(np.int64)
    toxic = rows["toxic"].to_numpy() > 0
    ys = [(toxic & rows["insult"].to_numpy()).astype(float), (toxic & rows["contempt"].to_numpy()).astype(float),
          toxic.astype(float)]
    return Chain(feats).fit(rows["doc_id"].to_numpy(), np.repeat(np.arange(len(rows)), lens), cols, ys)


def _scores(batch, chain, lookup):
    out = np.zeros((batch.num_rows, len(CATEGORIES)))
    for a, b, row, hashes in _features(batch.column("text")):
        r, f = _encode(lookup, row, hashes, b - a)
        out[a:b] = chain.proba(r, f, b - a)
    return np.round(out, 6)


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """(doc_id, p_insult, p_contempt, p_toxic, toxic) for every row."""
    def run(batches):
        lookup = Lookup(chain.feats)
        for batch in batches:
            p = _scores(batch, chain, lookup)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(p[:, k]) for k in range(3)), pa.array(p[:, 2] >= chain.cut)],
                names=["doc_id", "p_insult", "p_contempt", "p_toxic", "toxic"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, p_insult double, p_contempt double, "
        "p_toxic double, toxic boolean")


def keep_clean(docs: DataFrame, chain: Chain) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with their columns."""
    def run(batches):
        lookup = Lookup(chain.feats)
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch, chain, lookup)[:, 2] < chain.cut))

    return docs.mapInArrow(run, docs.schema)
