"""Exact de-duplication, whitening and tokenizer alignment against brute force on small
tables, with nulls, empty and repeated rows, ties, long texts, clashing extra columns and
empty inputs."""

import collections
import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from probity.llm import exactdedup, queries, tokalign, whitening

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row long, name string, k1 string, block string, "
          "pairs string, idx int, keep_id string")
EXTRA = ("en", "s", 1, 7, "n", "k", "b", "p", 3, "x")
GAP = re.compile("[\x20\x09-\x0d]")


def odd_texts():
    rng = random.Random(5)
    vocab = ["Lo", "ri", "straße", "naïve", "日本語", "x9", "🙂", "the", "of", " ", "don't", "12345", "\x85"]
    long = " ".join(rng.choices(vocab, k=3000))
    twin = long.replace(" ", "\n ")
    other = long[:-4] + "zz" + long[-4:]
    return [None, "", "   \n\t ", "one", " one", "o n\re", "One", "Two words", long, twin, long, other, long[:1000], "x" * 5000,
            "x" * 5001, "y" + "x" * 4999, "a▁b", "é" * 900, "<s>a</s><|endoftext|>", "\x00null", "  double  spaces  ", "tail \n",
            "مرحبا بالعالم", "﻿bom", "é combined", "​zero", "a b", long + " " + long]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, *EXTRA) for i, t in enumerate(odd_texts())]
    rows += [rows[8], rows[3], (None, "one", *EXTRA), (None, None, *EXTRA), (77, "one    ", *EXTRA)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def slow_identity(rows):
    """(doc_id, keep_id, group_size, kept, sha) of (doc_id, text) rows."""
    by = collections.defaultdict(list)
    for i, (d, t) in enumerate(rows):
        by[GAP.sub("", t or "")].append((-len(t or ""), d is None, d or 0, i))
    out = []
    for text, members in by.items():
        best = min(members)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(None if m[1] else m[2], None if best[1] else best[2], len(members), m == best, sha) for m in members]
    return collections.Counter(out)


@pytest.mark.parametrize("size", [16, 1000, exactdedup.BLOCK])
def test_exact_duplicates_equal_brute_force(docs, size):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = exactdedup.exact_duplicates(docs, size)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert collections.Counter(tuple(r) for r in got.collect()) == slow_identity(rows)


def test_identity_is_equal_only_for_equal_texts(docs):
    found = exactdedup.identities(docs, 16).collect()
    assert len({(r["level"], r["name"]) for r in found}) == len({r["text_sha256"] for r in found})
    assert max(r["level"] for r in found) >= 10                # long texts climb the levels


def test_blocks_that_share_their_hashes_start_again(spark, docs, monkeypatch):
    """With hashes of one bit at the first seed, the second seed's names are used."""
    real = exactdedup._blocks

    def weak(d, cols, seed, size):
        out = real(d, cols, seed, size)
        return out.withColumns({"k1": F.col("k1") % 2, "k2": F.lit(0)}) if seed == 1 else out

    monkeypatch.setattr(exactdedup, "_blocks", weak)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert collections.Counter(tuple(r) for r in exactdedup.exact_duplicates(docs).collect()) == slow_identity(rows)
    with pytest.raises(RuntimeError):
        exactdedup.identities(docs, seeds=[1])


def test_exact_duplicates_of_nothing(none):
    assert exactdedup.exact_duplicates(none).count() == 0


def test_keep_one(docs):
    left = exactdedup.keep_one(docs)
    assert left.columns == docs.columns
    texts = [GAP.sub("", r.text or "") for r in left.collect()]
    assert set(texts) == {GAP.sub("", r.text or "") for r in docs.collect()}


def test_exact_dedup_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    cols = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({queries.ORACLE_SQL['op11_exact_dedup']})").fetchall()
    got = queries.op11_exact_dedup(spark, SF_SMALL).select(cols).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)


def test_exact_dedup_runs_no_python(spark):
    held = exactdedup._blocks(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), ["doc_id"], 1, 1024)
    assert "Python" not in held._jdf.queryExecution().toString() and "Arrow" not in held._jdf.queryExecution().toString()


def slow_whitening(vectors, top=16):
    """{component: (explained, whitened by row)} and the deviations, by a dense eigenproblem."""
    x = np.array([[int(np.floor(float(c) * 64)) + 1_000_000 for c in v] for v in vectors], dtype=object)
    fit = np.array(sorted(set(map(tuple, x.tolist()))), dtype=object)
    n, s = len(fit), fit.sum(0)
    c = ((fit * n - s) / n).astype(float)
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1][:top], q[:, ::-1][:, :top]
    white = ((x * n - s) / n).astype(float) @ q / np.sqrt(np.maximum(e, 1e-300))
    return n, ((x * n - s) ** 2).sum(1).tolist(), e / np.trace(c.T @ c / n), white


def embeddings(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, x string, n string, component string")


def compare(got, vectors, rows):
    n, deviation, explained, white = slow_whitening(vectors)
    k = white.shape[1]
    got = got.sort_values(["vec_id", "component"], kind="stable")
    assert len(got) == rows * k and (got.n == n).all() and got.identity_error.max() < 1e-9
    assert got.deviation.tolist() == [d for d in deviation for _ in range(k)]
    assert np.allclose(got.explained.to_numpy().reshape(-1, k), explained, rtol=1e-9)
    mine = got.whitened.to_numpy().reshape(-1, k)
    sign = np.sign((mine * white).sum(0))
    assert np.allclose(mine * sign, white, atol=1e-7)


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(300, 20)) * np.geomspace(5, 0.2, 20) + 3
    v[50:60] = v[40]
    rows = [(i, [float(np.float32(c)) for c in x], "a", "b", "c") for i, x in enumerate(v)]
    odd = [(900, None, "a", "b", "c"), (901, [1.0] * 19 + [None], "a", "b", "c"), (902, [float("nan")] * 20, "a", "b", "c"),
           (903, [float("inf")] + [0.0] * 19, "a", "b", "c"), (904, [], "a", "b", "c"), (905, [1e30] * 20, "a", "b", "c")]
    got = whitening.whiten(embeddings(spark, rows + odd).repartition(5)).toPandas()
    assert not set(got.vec_id) & set(range(900, 910))
    compare(got, [r[1] for r in rows], 300)
    # a repeated row and a null id: one more result each, the fit as before
    more = whitening.whiten(embeddings(spark, rows + [rows[7], (None, *rows[8][1:])])).toPandas()
    assert len(more) == 302 * 16 and (more.n == 290).all() and (more[more.vec_id == 7].groupby("component").size() == 2).all()


def test_whitening_of_ill_conditioned_and_dependent_dimensions(spark):
    """Nearly and exactly dependent dimensions: components up to the rank, orthonormal all the same."""
    rng = np.random.default_rng(4)
    v = rng.normal(size=(400, 6)) * np.array([3e5, 40, 3, 0.5, 0.5, 0.2])
    v = np.hstack([v, v[:, :1], np.ones((400, 1)), v[:, 1:2]])                      # two copies and a constant
    v = np.floor(v * 64) / 64                                                       # sums of copies stay exact
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = whitening.whiten(df).toPandas()
    assert got.component.max() == 6 and len(got) == 2400 and got.identity_error.max() < 1e-6
    _, _, explained, _ = slow_whitening(v.tolist())
    assert np.allclose(got.explained.iloc[:3], explained[:3], rtol=1e-4)


def test_whitening_of_few_vectors_and_mixed_lengths(spark):
    none = embeddings(spark, [])
    assert whitening.whiten(none).count() == 0
    one = [(1, [1.0, 2.0], "a", "b", "c"), (2, [1.0, 2.0], "a", "b", "c")]
    assert whitening.whiten(embeddings(spark, one)).count() == 0
    mixed = one + [(3, [2.0, 5.0], "a", "b", "c"), (4, [1.0, 2.0, 3.0], "a", "b", "c"), (5, [4.0, 2.0, 1.0], "a", "b", "c")]
    got = whitening.whiten(embeddings(spark, mixed)).toPandas()
    assert sorted(got.vec_id) == [1, 2, 3, 4, 5] and (got.n == 2).all() and np.allclose(got.whitened.abs(), 1)


def test_deviation_beyond_a_long_is_exact_or_null():
    c = whitening.Centre(3, [0, 1])
    big = np.array([[1 << 20, 0], [1 << 40, 0]], np.int64)
    assert c.deviation(big) == [(3 << 20) ** 2 + 1, None]


def test_whitening_query(spark):
    got = queries.op12_embedding_whitening(spark, SF_CHECK).toPandas()
    src = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet").orderBy("vec_id").collect()
    compare(got, [r.embedding for r in src], len(src))


def paths():
    return queries.tokenizer(queries.BYTE_BPE)[0], queries.tokenizer(queries.PIECES)[0]


def slow_alignment(texts):
    """One row a text by the libraries, sets of ends and dictionaries."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, b_path = paths()
    ta, tb = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    ta.encode_special_tokens = True
    letters = tokalign.byte_letters()
    rows, holds = [], collections.Counter()
    for t in texts:
        whole = (" " + (t or "")).encode()
        a = ta.encode(" " + (t or ""), add_special_tokens=False)
        b = tb.encode(t or "")
        xa = [bytes(letters[c] for c in s) for s in a.tokens]
        xb = [bytes([int(p[3:5], 16)]) if tb.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [tb.id_to_piece(i)]]
        if not t or b"".join(xa) != whole or b"".join(xb) != whole:
            rows.append(None)
            continue
        ends = [np.cumsum([len(x) for x in y]).tolist() for y in (xa, xb)]
        shared = sorted(set(ends[0]) & set(ends[1]))
        group = lambda e: [int(np.searchsorted(shared, x)) for x in e]
        parts = [([], []) for _ in shared]
        for side, ids, e in ((0, a.ids, ends[0]), (1, b, ends[1])):
            for i, g in zip(ids, group(e)):
                parts[g][side].append(i)
        links = [(i, j) for x, y in parts for i in x for j in y]
        holds.update(set(links))
        name = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in parts)
        rows.append((len(a.ids), len(b), len(shared), links, hashlib.sha256(name.encode()).hexdigest()))
    most = collections.Counter()
    for (i, _), n in holds.items():
        most[i] = max(most[i], n)
    return [(0, 0, 0, 0, 0, 0, "") if r is None else
            (*r[:3], len(r[3]), sum(holds[k] == most[k[0]] for k in r[3]), sum(holds[k] for k in r[3]), r[4]) for r in rows]


@pytest.mark.parametrize("head", [tokalign.HEAD, 40, 0])
def test_alignment_equals_brute_force(docs, head, monkeypatch):
    monkeypatch.setattr(tokalign, "LINKS", 256)                 # groups in blocks, repeated ids counted first
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = collections.Counter((d, *r) for (d, _), r in zip(rows, slow_alignment([t for _, t in rows])))
    got = tokalign.alignment(docs, *paths(), head=head, slice_chars=2000)
    assert collections.Counter(tuple(r) for r in got.collect()) == want


def test_alignment_query(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: x for r, x in zip(rows, slow_alignment([r.text for r in rows]))}
    got = queries.op13_tokenizer_alignment(spark, SF_SMALL).collect()
    assert len(got) == len(rows) and all(tuple(r)[1:] == want[r.doc_id] for r in got)


def test_alignment_of_nothing(none):
    assert tokalign.alignment(none, *paths()).count() == 0


def test_large_groups_by_equal_ids():
    """One group of many tokens on both sides: links counted, not listed."""
    rng = np.random.default_rng(1)
    ga, gb = np.zeros(900, np.int64), np.zeros(800, np.int64)
    ia, ib = rng.integers(0, 7, 900), rng.integers(0, 5, 800)
    total = collections.Counter()
    for _, key, n in tokalign._group_pairs(ga, ia, gb, ib, np.array([900]), np.array([800]), 7, 5):
        assert len(key) <= 35
        for k, m in zip(key.tolist(), n.tolist()):
            total[divmod(k, 5)] += m
    assert total == collections.Counter({(a, b): int((ia == a).sum() * (ib == b).sum()) for a in range(7) for b in range(5)})


def test_shared_ends_equal_set_intersection():
    rng = random.Random(9)
    for _ in range(300):
        ea, eb, bounds, at = [], [], [0], 0
        for _ in range(rng.randint(1, 4)):
            n = rng.randint(1, 400)
            ea += [at + i for i in sorted({*rng.sample(range(1, n + 1), rng.randint(1, n)), n})]
            eb += [at + i for i in sorted({*rng.sample(range(1, n + 1), rng.randint(1, min(n, 5))), n})]
            at += n
            bounds.append(len(ea))
        got = tokalign.shared_ends(np.array(ea), np.array(eb), np.array(bounds))
        assert np.array(ea)[got].tolist() == sorted(set(ea) & set(eb))


def test_chunks_give_the_tokens_of_whole_texts(monkeypatch):
    c = tokalign.pair(*paths())
    assert c.cuttable
    texts = [t or "" for t in odd_texts()] + ["word  next  two \x1f x\u3000 y", "ends in space ", " ", "a ", "a  ", "\n a \n b ",
                                              "a b c d e f g h", "\u00a0 x \u2028 y", "'s 't don't 's", "x'll y '"]
    rng = random.Random(4)
    texts += ["".join(rng.choices("ab ' \n\t\u3000é1.▁\u0301", k=rng.randint(1, 30))) for _ in range(500)]
    def split(kind):
        return [x.tolist() for x in np.split(kind[0], np.cumsum(kind[1])[:-1])]

    cut = [split(k) for k in c.encode(texts)]
    monkeypatch.setattr(tokalign, "REMEMBER", 3)
    assert [[split(k)[0] for k in c.encode([t])] for t in texts[:60]] == [[a, b] for a, b in zip(cut[0][:60], cut[1][:60])]
    c.forget()
    monkeypatch.setattr(c, "cuttable", False)
    assert [split(k) for k in c.encode(texts)] == cut
    c.forget()
