"""Language identification with hyperdimensional profiles.

Every symbol (a lower-cased letter, or the gap between words) has a fixed random
+1/-1 vector of ``DIM`` components.  A trigram's vector binds its letters: the
first is rotated twice, the second once, and the three are multiplied.  A text
is the bundle (sum) of its trigram vectors, a language prototype the bundle of
its training texts; a text gets the language of greatest cosine.

Training sums are integers, added per partition and then by (lang, component),
so a prototype does not depend on the partitioning.  Only the prototypes, one
vector per language code, reach the driver; more than ``MAX_LANGS`` codes raise.

Defined cases: a null text or one without a letter is ``und`` with score 0;
equal cosines go to the smaller code; a table without a training row predicts
``und`` everywhere; a null doc_id is not held out and is not learned from.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probity.llm import textcore as tc

DIM = 1024
MAX_LANGS = 4096
_fold: list[np.ndarray] = []


def fold_table() -> np.ndarray:
    """Code point -> its lower-cased letter, or 0 for anything but a letter."""
    if not _fold:
        t = np.zeros(0x110000, np.uint32)
        for c in range(0x41, 0x40000):          # letters are in planes 0 to 3
            if unicodedata.category(s := chr(c))[0] == "L":
                low = s.lower()
                t[c] = ord(low) if len(low) == 1 else c
        _fold.append(t)
    return _fold[0]


def letter_vectors(codes: np.ndarray) -> np.ndarray:
    """Fixed random +1/-1 vectors, a function of the code point only."""
    bits = tc.mix(codes.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
                  + np.arange(DIM, dtype=np.uint64)[None, :])
    return ((bits >> np.uint64(40)) & np.uint64(1)).astype(np.int8) * 2 - 1


def _trigrams(codes: np.ndarray):
    """Trigram ids of each text of a slice.

    ``codes``: folded code points of all texts, each led and followed by a 0.
    Returns (position of each trigram, trigram id, letters of the distinct ids).
    """
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)   # one gap between words
    at = np.flatnonzero(keep)
    c = codes[at]
    syms, ids = np.unique(c, return_inverse=True)
    k = np.int64(len(syms))
    if len(c) < 3:
        return at[:0], np.zeros(0, np.int64), np.zeros((0, 3), np.uint32)
    tri = (ids[:-2] * k + ids[1:-1]) * k + ids[2:]
    ok = c[1:-1] != 0                                  # centred on a letter
    tri, pos = tri[ok], at[1:-1][ok]
    if k ** 3 <= 4_000_000:
        present = np.flatnonzero(np.bincount(tri, minlength=int(k ** 3)))
        lut = np.zeros(int(k ** 3), np.int32)
        lut[present] = np.arange(len(present))
        tid = lut[tri]
    else:
        present, tid = np.unique(tri, return_inverse=True)
    letters = np.stack([syms[present // (k * k)], syms[present // k % k], syms[present % k]], 1)
    return pos, tid, letters


def trigram_vectors(letters: np.ndarray) -> np.ndarray:
    syms, idx = np.unique(letters, return_inverse=True)
    idx = idx.reshape(letters.shape)
    v = letter_vectors(syms)
    return np.roll(v, 2, 1)[idx[:, 0]] * np.roll(v, 1, 1)[idx[:, 1]] * v[idx[:, 2]]


def profiles(texts, limit: int = 1 << 20):
    """For slices of a list of texts: (first, last, counts per text, trigram vectors).

    The counts are a list of (distinct trigram ids, their counts); one text
    longer than ``limit`` is a slice of its own.
    """
    fold, a = fold_table(), 0
    while a < len(texts):
        b, size = a, 0
        while b < len(texts) and (b == a or size + len(texts[b] or "") <= limit):
            size += len(texts[b] or "")
            b += 1
        raw = ["\0" + (t or "") + "\0" for t in texts[a:b]]
        codes = fold[np.frombuffer("".join(raw).encode("utf-32-le", "replace"), np.uint32)]
        edges = np.cumsum([0] + [len(t) for t in raw])
        pos, tid, letters = _trigrams(codes)
        cut = np.searchsorted(pos, edges)
        vec = trigram_vectors(letters) if len(letters) else np.zeros((0, DIM), np.int8)
        counts = []
        for i in range(b - a):
            n = np.bincount(tid[cut[i]:cut[i + 1]], minlength=len(letters))
            nz = np.flatnonzero(n)
            counts.append((nz, n[nz]))
        yield a, b, counts, vec
        a = b


def _learn(batches):
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for a, _b, counts, vec in profiles(batch.column("text").to_pylist()):
            sums: dict[str, np.ndarray] = {}
            for i, (ids, n) in enumerate(counts):
                s = sums.setdefault(langs[a + i], np.zeros(len(vec)))
                s[ids] += n
            for lang, s in sums.items():
                old = total.get(lang, 0)
                total[lang] = old + np.rint(s.astype(np.float64) @ vec.astype(np.float32)).astype(np.int64)
    for lang, v in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * DIM), pa.array(np.arange(DIM, dtype=np.int32)), pa.array(v)],
            names=["lang", "i", "v"])


def learn(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Prototypes of (text, lang) rows: (codes in order, unit vectors)."""
    sums = (labelled.filter("lang is not null and text is not null").select("text", "lang")
            .mapInArrow(_learn, "lang string, i int, v long")
            .groupBy("lang", "i").agg(F.sum("v").alias("v")))
    per = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("p"))
    rows = per.limit(MAX_LANGS + 1).collect()
    if len(rows) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} language codes")
    rows.sort(key=lambda r: r["lang"])
    langs = [r["lang"] for r in rows]
    m = np.array([[x["v"] for x in r["p"]] for r in rows], float).reshape(-1, DIM)
    return langs, m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)


def predictor(langs, protos):
    def predict(batches):
        p = protos.astype(np.float32).T
        for batch in batches:
            pred, score = [], []
            for _a, _b, counts, vec in profiles(batch.column("text").to_pylist()):
                for ids, n in counts:
                    if not len(ids) or not langs:
                        pred.append("und")
                        score.append(0.0)
                        continue
                    v = n.astype(np.float32) @ vec[ids].astype(np.float32)
                    cos = (v @ p) / max(float(np.linalg.norm(v)), 1e-12)
                    k = int(np.argmax(cos))
                    pred.append(langs[k])
                    score.append(float(min(max(cos[k], 0.0), 1.0)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(pred, pa.string()),
                 pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return predict


def identify(docs: DataFrame, model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for rows of (doc_id, held_out, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "held_out", "text").mapInArrow(
        predictor(*model), f"doc_id {kind}, held_out boolean, lang_pred string, score double")
