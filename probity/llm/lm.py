"""Gated recurrent language model over words, trained and run in numpy.

Counts: every document's tokens (lower-cased words, then one end) are numbered
within chunks of about ``CHUNK_TOKENS`` tokens.  A chunk's distinct tokens meet those
of the other chunks by hash, so each chunk learns the corpus counts of its own
words; the vocabulary is in no task and not on the driver as a whole.

Model: the most frequent training tokens, a power of two from the
square root of the vocabulary on (``Shape``), have their own input row and are dealt, by frequency, into classes of about
the square root of their number; all other tokens fall into ``TAILS`` classes by a hash
of their first two bytes, with one input row per class.
log P(token) = log P(class | state) + log P(token | class, state), two softmaxes, the
second over the class's tokens; in a tail class it is the smoothed count share within
that class.  The recurrent layer is a GRU of ``HIDDEN`` units.

Training: truncated backpropagation over windows of ``BPTT`` tokens, once over every
training document (``PASSES``), so the work grows with the corpus.  Every task trains
from the common weights on its documents, in lanes that grow from ``TRAIN_LANES`` to
``MOST_LANES``; weights are averaged by tokens.  Scoring walks whole documents in lanes, window by window,
and carries the state across windows to the document's end.

Defined cases: a null or empty text is one end token; with no training document
all counts are 0 and the model is its starting point; rows sharing a doc_id are
scored one by one; a null doc_id is not held out and trains.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from probity.llm import textcore as tc
from probity.llm.common import Scratch

LEAST, TAILS, HIDDEN = 512, 64, 16
BPTT, LANES = 16, 256
TRAIN_LANES, MOST_LANES, GROUP_STEPS, PART = 32, 512, 24, 1024
PASSES, RATE = 1, 0.02
CHUNK_TOKENS = 1_000_000
SUMS_BYTES = 1 << 25
BLOCK = 512
END = np.uint64(0x454E44)            # no word's hash by construction of the mixer but with chance 2^-64
_LN10 = np.log(10.0)


def _tokens(batch):
    """Yield (a, b, offsets, hashes, tail classes): the tokens of a slice of rows, ends included."""
    data, off = tc.column_bytes(batch.column("text"))
    for a, b in tc.row_slices(off):
        row, h, first = tc.scan(data, off[a:b + 1], tc.SPACED, (2,))
        n = np.bincount(row, minlength=b - a)
        at = np.concatenate([[0], np.cumsum(n + 1)])
        out = np.full(int(at[-1]), END)
        out[np.arange(len(h)) + row] = h
        tail = np.zeros(len(out), np.uint8)
        tail[np.arange(len(h)) + row] = first % np.uint64(TAILS)
        yield a, b, at, out, tail


class Shape:
    """How many words have a place of their own, and how they are dealt to classes."""

    def __init__(self, top: int):
        self.top, self.width = top, 1 << ((2 * top).bit_length() // 2)
        self.heads = top // self.width
        self.classes = self.heads + TAILS

    @classmethod
    def of(cls, vocabulary: int) -> "Shape":
        """A power of two from sqrt(vocabulary) on."""
        top = LEAST
        while top * top < vocabulary:
            top *= 2
        return cls(top)

    def class_of(self, ids):
        """Output class of each id: ids from ``top`` on are tail classes."""
        return np.where(ids < self.top, ids // self.width, ids - self.top + self.heads)


def _chunks(batches):
    """Rows of a chunk's vocabulary (idx, h, k, n) and one row with its documents."""
    part = TaskContext.get().partitionId()
    seq, docs, held, tails, size = 0, [], [], [], 0
    names = ["chunk", "idx", "h", "k", "n", "ids", "lens", "toks", "ks"]

    def flush():
        nonlocal seq
        chunk = (part << 24) | seq
        seq += 1
        every = np.concatenate(held)
        held.clear()
        lens = np.array([n for _, n, _ in docs], np.int64)
        mask = np.repeat(np.array([t for _, _, t in docs], bool), lens)
        vocab, inv = np.unique(every, return_inverse=True)
        n = np.bincount(inv[mask], minlength=len(vocab))
        tail = np.zeros(len(vocab), np.uint8)
        tail[inv] = np.concatenate(tails)
        k = len(vocab)
        for lo in range(0, k, 100_000):
            hi = min(k, lo + 100_000)
            nul = pa.nulls(hi - lo, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(hi - lo, chunk)), pa.array(np.arange(lo, hi, dtype=np.int32)),
                 pa.array(vocab[lo:hi].view(np.int64)), pa.array(tail[lo:hi].astype(np.int32)), pa.array(n[lo:hi]),
                 nul, nul, nul, nul], names=names)
        blob = lambda x: pa.array([x], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int64()), pa.array([-1], pa.int32()), pa.array([0], pa.int64()), pa.array([0], pa.int32()),
             pa.array([0], pa.int64()), blob(json.dumps([d for d, _, _ in docs]).encode()), blob(lens.tobytes()),
             blob(inv.astype(np.uint32).tobytes()), blob(tail.tobytes())], names=names)

    for batch in batches:
        ids, train_col = batch.column("doc_id").to_pylist(), batch.column("train").to_pylist()
        for a, b, at, h, tail in _tokens(batch):
            docs += [(ids[a + i], int(at[i + 1] - at[i]), train_col[a + i]) for i in range(b - a)]
            held.append(h)
            tails.append(tail)
            size += len(h)
            if size >= CHUNK_TOKENS:
                yield from flush()
                docs, held, tails, size = [], [], [], 0
    if docs:
        yield from flush()


class Gru:
    """Weights as one flat vector: input rows, recurrent weights, class and word outputs."""

    def __init__(self, counts):
        """counts: corpus counts of the top tokens (zeros beyond their number) and of the tail classes."""
        h, rng = HIDDEN, np.random.default_rng(11)
        top, rest = counts
        self.shape = shape = Shape(len(top))
        mass = np.append(top.reshape(shape.heads, shape.width).sum(1), np.broadcast_to(rest, TAILS))
        self.p = {
            "x": rng.normal(0, 0.3, (len(top) + TAILS, 3 * h)), "u": rng.normal(0, 0.2, (h, 3 * h)),
            "c": rng.normal(0, 0.01, (h, shape.classes)), "cb": np.log((mass + 0.5) / (mass.sum() + 0.5 * shape.classes)),
            "w": np.zeros((len(top), h)), "wb": np.log(top + 0.1)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def flat(self):
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)]).astype(np.float64)

    def load(self, v):
        at = 0
        for k in sorted(self.p):
            n = self.p[k].size
            self.p[k] = v[at:at + n].reshape(self.p[k].shape).astype(np.float32)
            at += n
        return self

    def step(self, s, a):
        """The state after one step; ``a``: the input rows of the step."""
        h = HIDDEN
        u = s @ self.p["u"]
        zr = a[:, :2 * h] + u[:, :2 * h]
        np.negative(zr, out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        m = zr[:, h:] * u[:, 2 * h:]
        m += a[:, 2 * h:]
        np.tanh(m, out=m)
        return zr[:, :h] * (s - m) + m

    def log_out(self, s, y):
        """log P(class) + log P(word | class) of top tokens, class part only for tail classes."""
        cls, out = self.shape.class_of(y), np.empty(len(y))
        for lo in range(0, len(y), BLOCK):
            cb = cls[lo:lo + BLOCK]
            logit = self.p["c"].T @ s[lo:lo + BLOCK].T     # a column a token
            logit += self.p["cb"][:, None]
            logit -= logit.max(0)
            own = logit[cb, np.arange(len(cb))].astype(np.float64)
            np.exp(logit, out=logit)
            out[lo:lo + BLOCK] = own - np.log(logit.sum(0))
        head = np.flatnonzero(cls < self.shape.heads)
        order = head[np.argsort(cls[head].astype(np.int16), kind="stable")]
        cut = np.searchsorted(cls[order], np.arange(self.shape.heads + 1))
        hc, place, more = s[order], y[order] % self.shape.width, np.empty(len(order))
        for c in range(self.shape.heads):
            i, lo = slice(cut[c], cut[c + 1]), c * self.shape.width
            if cut[c] < cut[c + 1]:
                l2 = self.p["w"][lo:lo + self.shape.width] @ hc[i].T
                l2 += self.p["wb"][lo:lo + self.shape.width, None]
                l2 -= l2.max(0)
                own = l2[place[i], np.arange(l2.shape[1])].astype(np.float64)
                np.exp(l2, out=l2)
                more[i] = own - np.log(l2.sum(0))
        out[order] += more
        return out

    def grads(self, xs, ys, ok, new, s0):
        """Gradient of the mean loss over a window, truncated at its start.

        ``xs``, ``ys`` [T, B]: input and target ids; ``ok`` marks targets that count, ``new`` the
        starts of documents.  Returns the gradients and the state after the window.
        """
        p, h = self.p, HIDDEN
        t, b = xs.shape
        g = {k: np.zeros_like(v) for k, v in p.items()}
        a = p["x"][xs]
        old, gates, cand, back_in = (np.empty((t, b, k * h), np.float32) for k in (1, 2, 1, 1))
        states = np.empty((t, b, h), np.float32)
        s = s0
        for i in range(t):
            old[i] = s
            old[i][new[i]] = 0
            s = old[i]
            u = s @ p["u"]
            zr = gates[i]
            np.add(a[i, :, :2 * h], u[:, :2 * h], out=zr)
            np.negative(zr, out=zr)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            back_in[i] = u[:, 2 * h:]
            m = cand[i]
            np.multiply(zr[:, h:], back_in[i], out=m)
            m += a[i, :, 2 * h:]
            np.tanh(m, out=m)
            s = zr[:, :h] * (s - m) + m
            states[i] = s
        n = max(int(ok.sum()), 1)
        keep = np.flatnonzero(ok.ravel())                  # padding has no target
        hs, y = states.reshape(-1, h)[keep], ys.ravel()[keep]
        cls = self.shape.class_of(y)
        ds, part = np.empty_like(hs), np.float32(1 / n)
        ones = np.ones(max(len(y), BLOCK, self.shape.classes, self.shape.width), np.float32)
        rows = np.arange(max(len(y), BLOCK))
        for lo in range(0, len(y), BLOCK):                 # a block of the class softmax stays in cache
            hb, cb = hs[lo:lo + BLOCK], cls[lo:lo + BLOCK]
            pr = p["c"].T @ hb.T                           # a column a token: its maximum is found along rows
            pr += p["cb"][:, None]
            pr -= pr.max(0)
            np.exp(pr, out=pr)
            pr *= part / (ones[:len(pr)] @ pr)
            pr[cb, rows[:len(cb)]] -= part
            g["c"] += (pr @ hb).T
            g["cb"] += pr @ ones[:len(cb)]
            np.matmul(pr.T, p["c"].T, out=ds[lo:lo + BLOCK])
        head = np.flatnonzero(cls < self.shape.heads)      # tail classes end with the class
        order = head[np.argsort(cls[head].astype(np.int16), kind="stable")]
        cut = np.searchsorted(cls[order], np.arange(self.shape.heads + 1))
        hc, dc, place = hs[order], np.empty((len(order), h), np.float32), y[order] % self.shape.width
        for c in range(self.shape.heads):
            i, lo = slice(cut[c], cut[c + 1]), c * self.shape.width
            if cut[c] == cut[c + 1]:
                continue
            w = p["w"][lo:lo + self.shape.width]
            q = w @ hc[i].T
            q += p["wb"][lo:lo + self.shape.width, None]
            q -= q.max(0)
            np.exp(q, out=q)
            q *= part / (ones[:len(q)] @ q)
            k = q.shape[1]
            q[place[i], rows[:k]] -= part
            np.matmul(q, hc[i], out=g["w"][lo:lo + self.shape.width])
            g["wb"][lo:lo + self.shape.width] = q @ ones[:k]
            np.matmul(q.T, w, out=dc[i])
        ds[order] += dc
        d_all = np.zeros((t * b, h), np.float32)
        d_all[keep] = ds
        d_all = d_all.reshape(t, b, h)
        da, db = np.empty((t, b, 3 * h), np.float32), np.empty((t, b, 3 * h), np.float32)
        back = np.zeros((b, h), np.float32)
        for i in range(t - 1, -1, -1):
            z, r, m = gates[i, :, :h], gates[i, :, h:], cand[i]
            d = d_all[i] + back
            dm = d * (1 - z) * (1 - m * m)
            da[i, :, :h] = d * (old[i] - m) * z * (1 - z)
            da[i, :, h:2 * h] = dm * back_in[i] * r * (1 - r)
            da[i, :, 2 * h:] = dm
            db[i] = da[i]
            db[i, :, 2 * h:] *= r
            back = d * z + db[i] @ p["u"].T
            back[new[i]] = 0
        g["u"] = old.reshape(-1, h).T @ db.reshape(-1, 3 * h)
        order = np.argsort(xs.ravel().astype(np.int16), kind="stable")     # one scatter: equal inputs side by side
        ids = xs.ravel()[order]
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        g["x"][ids[first]] = np.add.reduceat(da.reshape(-1, 3 * h)[order], first, axis=0)
        return g, s


def _lanes(lens, lanes):
    """Deal documents to lanes, the longest first to the emptiest."""
    import heapq
    heap = [(0, i) for i in range(min(lanes, max(1, len(lens))))]
    out = [[] for _ in heap]
    for d in np.argsort(-lens, kind="stable"):
        load, i = heapq.heappop(heap)
        out[i].append(int(d))
        heapq.heappush(heap, (load + int(lens[d]), i))
    return out


def _grid(ids, at, lanes):
    """Token ids by lane: (y [L, T], start flags, document index); -1 pads."""
    total = [sum(int(at[d + 1] - at[d]) for d in lane) for lane in lanes]
    order = np.argsort(-np.array(total), kind="stable")       # long lanes first: active lanes are a prefix
    lanes, total = [lanes[i] for i in order], [total[i] for i in order]
    t = max(total, default=0)
    y = np.full((len(lanes), t), -1, np.int32)
    doc = np.zeros((len(lanes), t), np.int32)
    new = np.zeros((len(lanes), t), bool)
    for i, lane in enumerate(lanes):
        k = 0
        for d in lane:
            n = int(at[d + 1] - at[d])
            y[i, k:k + n], doc[i, k:k + n], new[i, k] = ids[at[d]:at[d + 1]], d, True
            k += n
    return y, new, doc, np.array(total)


def score_docs(net: Gru, ids, at, end_id):
    """Natural-log scores of whole documents (class part only for tail classes)."""
    out = np.zeros(len(at) - 1)
    lens = np.diff(at)
    # groups of lanes bound the grid's memory
    for lo, hi in _doc_groups(lens):
        y, new, doc, total = _grid(ids, at[lo:hi + 1], _lanes(lens[lo:hi], LANES))
        s = np.zeros((len(y), HIDDEN), np.float32)
        for t0 in range(0, y.shape[1], BPTT):
            live = int((total > t0).sum())
            t1 = min(y.shape[1], t0 + BPTT)
            s, states = s[:live], []
            prev = y[:live, t0 - 1:t1 - 1] if t0 else np.concatenate([np.full((live, 1), end_id, np.int32), y[:live, :t1 - 1]], 1)
            start = new[:live, t0:t1].T
            a = net.p["x"][np.where(start | (prev.T < 0), end_id, prev.T)]
            some = start.any(1)
            for i in range(t1 - t0):
                s = net.step(np.where(start[i][:, None], np.float32(0), s) if some[i] else s, a[i])
                states.append(s)
            yy = y[:live, t0:t1].T.ravel()
            ok = yy >= 0
            lp = net.log_out(np.concatenate(states)[ok], yy[ok])
            out[lo:hi] += np.bincount(doc[:live, t0:t1].T.ravel()[ok], lp, hi - lo)
    return out


def _doc_groups(lens, limit=2_000_000):
    """Ranges of documents of about ``limit`` tokens."""
    cum = np.concatenate([[0], np.cumsum(lens)])
    lo = 0
    while lo < len(lens):
        hi = max(lo + 1, int(np.searchsorted(cum, cum[lo] + limit, "right")) - 1)
        yield lo, min(hi, len(lens))
        lo = min(hi, len(lens))


def _ids_of(vocab, tail, tops, top):
    """Class-ordered id of each hash; ``top`` + tail class for all that are not among ``tops``."""
    other = top + tail.astype(np.int32)
    if not len(tops):
        return other
    o = np.argsort(tops)
    at = np.minimum(np.searchsorted(tops[o], vocab), len(tops) - 1)
    return np.where(tops[o][at] == vocab, o[at], other).astype(np.int32)


def _end_id(tops, top):
    return int(_ids_of(np.array([END]), np.zeros(1, np.uint8), tops, top)[0])


class Learner:
    """Adam over windows of whole training documents.

    Documents are dealt to lanes in parts of at most ``PART`` tokens, so lanes end
    together; a part's first input is the token before it, its state starts at zero.
    Lanes grow from ``TRAIN_LANES`` to ``MOST_LANES`` as training goes on.
    """

    def __init__(self, net: Gru, end_id: int):
        self.net, self.end_id, self.lanes, self.steps = net, end_id, TRAIN_LANES, 0
        self.m = {k: np.zeros_like(v) for k, v in net.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in net.p.items()}

    def documents(self, ids, at):
        """Learn from the documents that ``at`` delimits in ``ids``; each token once."""
        prev = np.empty_like(ids)
        prev[1:] = ids[:-1]
        prev[at[:-1]] = self.end_id
        lo = 0
        while lo < len(at) - 1:
            limit = self.lanes * BPTT * GROUP_STEPS
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
            self.group(ids, prev, at[lo:hi + 1])
            self.lanes = min(2 * self.lanes, MOST_LANES)
            lo = hi

    def group(self, ids, prev, at):
        n = int(at[-1] - at[0])
        size = max(BPTT, min(PART, -(-n // self.lanes)))
        parts = np.unique(np.concatenate([at, np.arange(at[0], at[-1], size)]))
        y, new, _, total = _grid(ids, parts, _lanes(np.diff(parts), self.lanes))
        x, _, _, _ = _grid(prev, parts, _lanes(np.diff(parts), self.lanes))
        s = np.zeros((len(y), HIDDEN), np.float32)
        for t0 in range(0, y.shape[1], BPTT):
            live = int((total > t0).sum())
            ys = np.ascontiguousarray(y[:live, t0:t0 + BPTT].T)
            xs = np.ascontiguousarray(x[:live, t0:t0 + BPTT].T)
            ok = ys >= 0
            g, s = self.net.grads(np.where(ok, xs, self.end_id), np.maximum(ys, 0), ok, new[:live, t0:t0 + BPTT].T, s[:live])
            self.update(g)

    def update(self, g):
        self.steps += 1
        rate = RATE * min(1.0, self.steps / 20) * np.sqrt(1 - 0.99 ** self.steps) / (1 - 0.9 ** self.steps)
        for k, w in self.net.p.items():
            m, v, d = self.m[k], self.v[k], g[k]
            m *= np.float32(0.9)
            m += np.float32(0.1) * d
            v *= np.float32(0.99)
            v += np.float32(0.01) * d * d
            w -= np.float32(rate) * m / (np.sqrt(v) + np.float32(1e-6))


def _trainer(tops, counts, weights, groups):
    end_id = _end_id(tops, len(counts[0]))

    def run(batches):
        net = Gru(counts).load(weights)
        learner, seen = Learner(net, end_id), 0
        for batch in batches:
            for _a, _b, at, h, tail in _tokens(batch):
                learner.documents(_ids_of(h, tail, tops, net.shape.top), at)
                seen += int(at[-1])
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId() % groups], pa.int32()), pa.array([seen], pa.int64()),
                 pa.array([(net.flat() * seen).tobytes()], pa.binary())], names=["g", "n", "w"])

    return run


def _add_up(batches):
    total, n = None, 0
    for batch in batches:
        for k, w in zip(batch.column("n").to_pylist(), batch.column("w").to_pylist()):
            total = np.frombuffer(w, np.float64) + (0 if total is None else total)
            n += k
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([n], pa.int64()),
                                          pa.array([total.tobytes()], pa.binary())], names=["g", "n", "w"])


def train(docs: DataFrame, tops, counts) -> np.ndarray:
    """Averaged weights; the partial sums that reach the driver have at most ``SUMS_BYTES`` together, or are one."""
    weights = Gru(counts).flat()
    groups = int(max(1, min(64, SUMS_BYTES // weights.nbytes)))
    for _ in range(PASSES):
        rows = (docs.select("text").mapInArrow(_trainer(tops, counts, weights, groups), "g int, n long, w binary")
                .repartition(groups, "g").mapInArrow(_add_up, "g int, n long, w binary").collect())
        n = sum(r["n"] for r in rows)
        if n:
            weights = sum(np.frombuffer(r["w"], np.float64) for r in rows) / n
    return weights


def score(docs: DataFrame, held_out) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for every row.

    ``held_out``: a boolean column expression; the other rows are learned from.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       (~F.coalesce(held_out, F.lit(False))).alias("train"))
    raw = scratch.write(docs.mapInArrow(
        _chunks, "chunk long, idx int, h long, k int, n long, ids binary, lens binary, toks binary, ks binary"))
    words = raw.filter("idx >= 0").select("chunk", "idx", "h", "k", "n")
    w = Window.partitionBy("h")
    counted = scratch.write(words.select(
        "chunk", "idx", "h", "k", F.sum("n").over(w).alias("c"),
        (F.min("chunk").over(w) == F.col("chunk")).alias("once")))        # a chunk has a word once
    known = counted.filter("once and c > 0")
    mass, distinct = np.zeros(TAILS), np.zeros(TAILS)
    for r in known.groupBy("k").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():   # TAILS rows at most
        mass[r["k"]], distinct[r["k"]] = r["n"], r["v"]
    big_n, big_v = int(mass.sum()), int(distinct.sum())
    top = Shape.of(big_v).top
    rows = known.orderBy(F.desc("c"), "h").select("h", "k", "c").limit(top).collect()
    tops = np.array([r["h"] for r in rows], np.int64).view(np.uint64)
    top_c = np.zeros(top)
    top_c[:len(rows)] = [r["c"] for r in rows]
    for r in rows:
        mass[r["k"]] -= r["c"]
        distinct[r["k"]] -= 1
    counts = (top_c, mass)
    weights = train(docs.filter("train"), tops, counts) if big_n else Gru(counts).flat()

    base_den = big_n + 0.1 * (big_v + 1)
    tail_den = mass + 0.1 * (distinct + 1)
    end_id = _end_id(tops, top)

    def run(_key, mine, theirs):
        payload = mine.to_pylist()[0]
        ids = json.loads(payload["ids"])
        lens = np.frombuffer(payload["lens"], np.int64)
        toks = np.frombuffer(payload["toks"], np.uint32).astype(np.int64)
        tail = np.frombuffer(payload["ks"], np.uint8)
        word, c = np.zeros(len(tail), np.int32), np.zeros(len(tail))
        idx = theirs.column("idx").to_numpy()
        word[idx], c[idx] = theirs.column("word").to_numpy(), theirs.column("c").to_numpy()
        at = np.concatenate([[0], np.cumsum(lens)])
        doc = np.repeat(np.arange(len(lens)), lens)
        n = len(lens)
        base = np.bincount(doc, np.log10((c + 0.1) / base_den)[toks], n)
        share = np.where(word >= top, np.log10((c + 0.1) / tail_den[tail]), 0.0)
        known_n = np.bincount(doc, (c > 0)[toks], n).astype(np.int64)
        net = Gru(counts).load(weights)
        logp = score_docs(net, word[toks], at, end_id) / _LN10 + np.bincount(doc, share[toks], n)
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_tokens": pa.array(lens), "n_known": pa.array(known_n),
                         "base_score": pa.array(base), "score": pa.array(logp)})

    mine = raw.filter("idx < 0").select("chunk", "ids", "lens", "toks", "ks")
    head = spark.createDataFrame([(r["h"], i) for i, r in enumerate(rows)], "h long, word int")     # ``top`` rows at most
    theirs = counted.join(F.broadcast(head), "h", "left").select(
        "chunk", "idx", "c", F.coalesce("word", F.col("k") + F.lit(top)).alias("word"))
    out = mine.groupBy("chunk").cogroup(theirs.groupBy("chunk")).applyInArrow(
        run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "n_tokens", "n_known", F.lit(big_n).cast("long").alias("train_tokens"), "base_score", "score")
