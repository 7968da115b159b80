"""Every corpus operator against brute force on small tables, with nulls, empty
and repeated rows, ties, clashing extra columns and empty inputs."""

import collections
import hashlib
import itertools
import random
import re
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from probity.llm import (balltree, bpe, decontam, htmltext, langid, licenses, linededup, lm, minhash, queries, textcore,
                         toxicity)

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, band string, token string, w string, "
          "`__line_gon` string")


def words(pattern, text):
    return pattern.findall((text or "").translate(LOWER))


def odd_texts():
    rng = random.Random(3)
    vocab = [f"{a}{b}" for a in ("Lo", "ri", "ma", "té", "ün") for b in ("sa", "ko", "pel", "x9")]
    long = [" ".join(rng.choices(vocab, k=40)) for _ in range(6)]
    near = long[0].split()
    near[7] = "changed"
    return [None, "", "   \n ", "one", "Two words", long[0], long[0], " ".join(near), "\n".join(long[:3]),
            "\n".join(long[2:5]), long[1] + " tail", "!!! ... ###", "a b c d e f g h i j k l", "x" * 30_000, "é" * 50,
            " ".join(vocab * 400), "All rights reserved. Licensed under CC BY-NC 4.0.", "the GNU General Public License, "
            "all rights reserved", long[3] + "\n" + long[3]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", len(t or ""), "b", "t", "w", "g") for i, t in enumerate(odd_texts())]
    rows.append(rows[5])                                            # a repeated row
    rows.append((None, odd_texts()[5], None, None, None, None, None, None, None))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_scan_equals_regex():
    rng = random.Random(1)
    for table, pattern in ((textcore.SPACED, SPACED), (textcore.ALNUM, ALNUM)):
        texts = ["".join(rng.choices("aB é\n\t.x1-ß", k=rng.randint(0, 60))) for _ in range(200)]
        import pyarrow as pa
        data, off = textcore.column_bytes(pa.array(texts))
        row, h, p4 = textcore.scan(data, off, table, (4,))
        flat = [(i, w) for i, t in enumerate(texts) for w in words(pattern, t)]
        assert row.tolist() == [i for i, _ in flat]
        by = collections.defaultdict(set)
        for (_, w), x in zip(flat, h.tolist()):
            by[w].add(x)
        assert all(len(v) == 1 for v in by.values()) and len({x for v in by.values() for x in v}) == len(by)
        assert [x == 0 for x in p4.tolist()] == [len(w.encode()) < 4 for _, w in flat]


def test_long_text_in_pieces(monkeypatch):
    import pyarrow as pa
    texts = ["alpha beta " * 50, "x" * 300, "gamma " * 30, ""]
    data, off = textcore.column_bytes(pa.array(texts))
    whole = textcore.scan(data, off, textcore.SPACED)
    monkeypatch.setattr(textcore, "CHUNK", 64)
    parts = textcore.scan(data, off, textcore.SPACED)
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_language_id(spark, none):
    t = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    out = queries.op1_language_id(spark, SF_CHECK).join(t.select("doc_id", "lang"), "doc_id").toPandas()
    held = out[out.held_out & out.lang.notna()]
    assert len(held) > 100 and (held.lang == held.lang_pred).mean() > 0.98
    assert all((zlib.crc32(str(i).encode()) % 4 == 2) == h for i, h in zip(out.doc_id, out.held_out))
    model = langid.learn(t.filter("lang = 'en' or lang = 'de'"))
    odd = spark.createDataFrame([(1, False, None), (2, False, "123 ..."), (3, True, "")], "doc_id long, held_out boolean, text string")
    assert {(r.lang_pred, r.score) for r in langid.identify(odd, model).collect()} == {("und", 0.0)}
    empty = langid.learn(none)
    assert empty[0] == [] and langid.identify(none.withColumn("held_out", F.lit(False)), empty).count() == 0


def brute_components(rows, num, den):
    sets, parent = {}, {}
    for i, t in rows:
        w = words(SPACED, t)
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
        parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        inter = len(sets[a] & sets[b])
        if sets[a] and sets[b] and den * inter >= num * (len(sets[a]) + len(sets[b]) - inter):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_duplicates(spark, docs, none, monkeypatch):
    base = "w" + " w".join(str(i) for i in range(300))
    chain = []
    for k in range(12):                       # a chain: neighbours are similar, the ends are not
        w = base.split()
        w[: k * 12] = [f"n{k}_{i}" for i in range(k * 12)] if k % 2 else [f"m{i}" for i in range(k * 12)]
        chain.append((100 + k, " ".join(w)))
    rows = [(i, t) for i, t in enumerate(odd_texts())] + chain
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(minhash, "BLOCK", 3)  # many blocks
    for num in (85, 80, 50):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, num, 100).collect()}
        assert got == brute_components(rows, num, 100)
    out = minhash.near_duplicates(docs).collect()
    assert len(out) == docs.count()
    assert [r.kept for r in out if r.doc_id is None] == [True]
    assert minhash.near_duplicates(none).count() == 0


def test_near_duplicates_behind_different_hubs(spark):
    """Two near copies hold a common passage; each bucket they share has another hub, a carrier of the passage."""
    import pyarrow as pa
    rng = random.Random(2)
    passage = [f"p2_{i}" for i in range(204)]
    pair = [" ".join(passage + [f"{x}{i}" for i in range(17)]) for x in "ab"]

    def keys(text):
        (_a, _b, _at, h), = minhash._doc_sets(pa.array([text]))
        return set(minhash.band_keys(minhash.signature(h, minhash.BANDS * minhash.ROWS)).tolist())

    ka, kb = map(keys, pair)
    open_, carriers, seen = ka & kb, [], set()
    while len(open_) > 1:
        text = " ".join(passage + [f"c{rng.randrange(10**9)}" for _ in range(150)])
        k = keys(text)
        # one bucket with the pair, which no other carrier covers, and none with other carriers
        if len(k & ka) == 1 and len(k & kb) == 1 and k & ka & open_ and not k & seen:
            carriers.append(text)
            open_ -= k
            seen |= k
    rows = list(enumerate(carriers)) + [(100_000 + i, t) for i, t in enumerate(pair)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df).collect()}
    assert len(carriers) > 10 and got == brute_components(rows, 85, 100)
    assert got[100_001][1] == 100_000


def test_signature_collisions_follow_jaccard():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 400).astype(np.uint64)
    a, b = pool[:300], pool[50:350]           # Jaccard 250 / 350
    same = [np.mean(minhash.signature(textcore.mix(a + np.uint64(s)), 256) == minhash.signature(textcore.mix(b + np.uint64(s)), 256))
            for s in range(30)]
    assert abs(np.mean(same) - 250 / 350) < 0.03
    assert len(minhash.signature(pool[:1], 256)) == 256     # all bins filled from one


def test_toxicity(spark, docs, none):
    out = queries.op3_toxicity(spark, SF_CHECK).toPandas()
    lab = spark.read.parquet(f"{SF_CHECK}/labels.parquet").toPandas()
    m = out.merge(lab, on="doc_id")
    assert ((m.toxic_x.astype(int) == m.toxic_y).mean()) > 0.97
    assert len(out) == 1000 and out.p_toxic.between(0, 1).all()
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    chain = toxicity.train(docs, labels)
    assert not chain.models and toxicity.keep_clean(docs, chain).count() == docs.count()
    assert toxicity.keep_clean(docs, chain).columns == docs.columns
    assert toxicity.score(none, chain).count() == 0


def test_chain_uses_out_of_fold_probabilities():
    rng = np.random.default_rng(0)
    n = 600
    y1 = rng.random(n) < 0.4
    rows, cols = np.flatnonzero(y1), np.zeros(int(y1.sum()), np.int64)
    y2 = y1.astype(float)                     # only known through the first category
    chain = toxicity.Chain(np.zeros(1, np.uint64)).fit(np.arange(n), rows, cols, [y1.astype(float), y2])
    assert chain.oof > 0.99 and chain.models[1].w.size == toxicity.FEATURES + 2
    assert chain.models[1].w[toxicity.FEATURES] > 0.5


def tiktoken_encoding():
    import base64

    import tiktoken
    path, pattern = queries.tokenizer()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def test_bpe_tree_equals_library(spark, docs, none):
    enc, c = tiktoken_encoding(), bpe.coder(*queries.tokenizer())
    rng = random.Random(2)
    texts = [t or "" for t in odd_texts()]
    texts += ["".join(rng.choices(["a", "B", " ", "  ", "\n", "'s", "'", "7", "é", "漢", "\x1c", " ", " ", "!", "I'll", "👍"],
                                  k=rng.randint(0, 120))) for _ in range(400)]
    for t in texts:
        want = enc.encode_ordinary(t)
        for leaf in (1, 3, 17, 1 << 14):
            if len(t) > 2000 and leaf < 17:
                continue
            assert c.encode(t, leaf) == want
        assert c.decode(want) == t.encode()
    out = {r.doc_id: r for r in bpe.encode(docs.filter("doc_id is not null"), *queries.tokenizer()).collect()}
    assert all((t or "") == out[i].decoded for i, t in enumerate(odd_texts()))
    dig = bpe.encode_digests(docs, *queries.tokenizer()).filter("doc_id = 5").collect()
    want = enc.encode_ordinary(odd_texts()[5])
    assert len(dig) == 2 and dig[0].n_tokens == len(want)
    assert dig[0].ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
    assert bpe.encode(none, *queries.tokenizer()).count() == 0


def brute_lines(rows):
    seen, out = [], {}
    for i, t in sorted(rows):
        gone = []
        for k, line in enumerate((t or "").split("\n")):
            s = set(words(ALNUM, line))
            if len(s) < linededup.MIN_WORDS:
                continue
            if any(5 * len(s & x) >= 4 * len(s | x) for x in seen):
                gone.append(k)
            seen.append(s)
        out[i] = gone
    return out


def test_line_dedup(spark, docs, none):
    rng = random.Random(9)
    rows = list(enumerate(odd_texts()))
    pool = [[f"v{rng.randint(0, 60)}" for _ in range(rng.randint(2, 30))] for _ in range(25)]
    for i in range(100, 160):
        lines = []
        for _ in range(rng.randint(1, 6)):
            w = list(rng.choice(pool))
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = f"u{rng.randint(0, 9)}"
            lines.append(" ".join(w))
        rows.append((i, "\n".join(lines)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: list(r.removed) for r in linededup.line_report(df).collect()}
    want = brute_lines(rows)
    assert got == want
    kept = {r.doc_id: r.text for r in linededup.drop_repeated_lines(df).collect()}
    for i, t in rows:
        left = [x for k, x in enumerate((t or "").split("\n")) if k not in want[i]]
        if not want[i]:
            assert kept[i] == t
        elif any(words(ALNUM, x) for x in left):
            assert kept[i] == "\n".join(left)
        else:
            assert i not in kept
    out = linededup.drop_repeated_lines(docs)
    assert out.columns == docs.columns and out.filter("doc_id is null").count() == 1
    assert linededup.line_report(none).count() == 0 and linededup.drop_repeated_lines(none).count() == 0


def test_short_lines_are_repeated_lines(spark):
    rng = random.Random(4)
    short = ["Read more", "more read", "Subscribe now", "ha ha ha ha", "one", "a b c", "a b d", "a b c d", "a b c d e", "!!!", ""]
    rows = [(i, "\n".join(rng.choices(short, k=rng.randint(1, 5)))) for i in range(80)]
    seen, want = [], {}
    for i, t in rows:
        want[i] = []
        for k, line in enumerate(t.split("\n")):
            s = set(words(ALNUM, line))
            if s and any(5 * len(s & x) >= 4 * len(s | x) for x in seen):
                want[i].append(k)
            seen.append(s)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {r.doc_id: list(r.removed) for r in linededup.line_report(df).collect()} == want
    assert sum(map(len, want.values())) > 100


def test_line_dedup_spreads_hot_words(spark, monkeypatch):
    rng = random.Random(6)
    rows = []
    for i in range(90):                       # lines of the same few words: every word is hot
        lines = [" ".join(rng.sample([f"h{k}" for k in range(14)], rng.randint(4, 12))) for _ in range(4)]
        rows.append((i, "\n".join(lines)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(linededup, "CELL", 16)
    monkeypatch.setattr(linededup, "LOCAL", 1)
    sizes, dealt = [], linededup._cells

    def watched(*args):
        out = dealt(*args)
        sizes.extend(r["count"] for r in out.groupBy("token", "p", "q").count().collect())
        return out

    monkeypatch.setattr(linededup, "_cells", watched)
    assert {r.doc_id: list(r.removed) for r in linededup.line_report(df).collect()} == brute_lines(rows)
    assert len(sizes) > 14 and max(sizes) < 5 * 16


def test_licenses(spark, docs, none):
    phrases = [(p.split(), lab) for p, lab in licenses.BASE.items()]
    for r in licenses.scan(docs.filter("doc_id is not null")).collect():
        w = words(ALNUM, odd_texts()[r.doc_id])
        at = [(j, lab) for p, lab in phrases for j in range(len(w) - len(p) + 1) if w[j:j + len(p)] == p]
        assert (r.n_words, r.n_base) == (len(w), len(at))
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert r.base_labels == ",".join(sorted({lab for _, lab in at}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    text = "x " * 30 + "Redistribution and use, in source and binary forms, with or without any modification, are permitted provided that the following conditions are met"
    one = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert licenses.scan(one).first().labels == "bsd"            # one word inserted: two diagonals
    assert licenses.scan(docs).count() == docs.count() and licenses.scan(none).count() == 0


def test_top_k(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(0, 0.2, (700, 12)), 2)
    x[10] = x[20] = x[30]
    rows = [(i, [float(v) for v in x[i]]) for i in range(700)]
    rows += [(1000, None), (1050, [float("nan")] * 12), (1051, [None] * 12), (1100, [1.0] * 3), (1101, [0.5] * 3)]
    df = balltree.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    monkeypatch.setattr(balltree, "SHARD", 100)
    monkeypatch.setattr(balltree, "RUN", 3)
    out = collections.defaultdict(list)
    for r in balltree.top_k(df, df.filter("vec_id % 50 = 0"), 5).orderBy("query_id", "rank").collect():
        out[r.query_id].append((r.vec_id, r.score))
    q = np.floor(x.astype(np.float32).astype(float) * 256).astype(np.int64)
    for i in range(0, 700, 50):
        s = q @ q[i]
        best = [j for j in np.lexsort((np.arange(700), -s)) if j != i][:5]
        assert out[i] == [(int(j), int(s[j])) for j in best]
    assert out[1100] == [(1101, 3 * 256 * 128)] and 1000 not in out and 1050 not in out
    none = df.limit(0)
    assert balltree.top_k(none, none, 5).count() == 0


def test_html(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    model = htmltext.train(pages)
    head = "<html><head><title>T</title><style>p{}</style></head><body>"
    para = "This is a rather long paragraph of the article, with enough words to look like one. " * 3
    cases = {
        head + f"<nav><ul><li><a href='/'>Home</a></li></ul></nav><article><h1>Title &amp; more</h1><p>{para}<p>Second&nbsp;one <b>bold</b>.</article>"
        "<footer>&copy; site</footer>": f"Title & more\n{para.strip()}\nSecond one bold .".replace("bold .", "bold."),
        head + f"<div class='cookie notice'>We use cookies</div><article><p>{para}</p></article><div class='comments'><p>{para}</p></div>": para.strip(),
        head + f"<aside class='sidebar'><a href=x>Link</a></aside><article><p>{para}</p><form><input><p>Mail us</p></form></article>": para.strip(),
        "": "", None: "", "<p": ""}
    df = spark.createDataFrame([(i, "u", h) for i, h in enumerate(cases)], "page_id long, url string, html string")
    got = {r.page_id: r for r in htmltext.main_text(df, model).collect()}
    for i, want in enumerate(cases.values()):
        assert got[i].text == want, i
        assert got[i].n_chars == len(want)
    keep = htmltext.decode([-1, 0, 1, 0], np.array([3.0, -5.0, 2.0, 1.0]))
    assert keep.tolist() == [True, False, False, True]           # no kept child under a dropped parent
    empty = htmltext.main_text(df.limit(0), htmltext.train(df.limit(0)))
    assert empty.count() == 0


def test_html_elements_without_end_tag():
    def runs(source):
        return [t for _, t in htmltext.Page(source).blocks()]

    for tag in ("button", "select", "noscript", "object", "svg", "iframe", "template"):
        assert runs(f"<body><{tag}>Menu<article><p>One</p><p>Two</p></article>") == ["One", "Two"], tag
        assert runs(f"<body><div><{tag}>Menu</div><p>One</p><div><p>Two</p></{tag}></div>") == ["One", "Two"], tag
        assert runs(f"<p>One <{tag}>Share</p><p>Two</p>") == ["One", "Two"], tag
        # closed ones are left out whole
        assert runs(f"<p>One <{tag}><div>in<b>side</b></div></{tag}>more</p><p>Two</p>") == ["One more", "Two"], tag
    assert runs("<body><button>Menu<article><p>One</p></article><button>Go</button><p>Two</p>") == ["One", "Two"]
    assert runs("<p>One<svg><svg>a</svg>b</svg></p>") == ["One"]
    assert runs("<p>One</p><script>two<p>three") == ["One"]


def test_decontamination(spark, docs, none):
    long = odd_texts()[5].split()
    items = [(1, " ".join(long[3:20])), (2, "one"), (3, None), (4, "..."), (5, " ".join(long[5:25])), (5, "d e f")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    wins = collections.defaultdict(set)
    for i, t in items:
        w = words(ALNUM, t)
        k = min(10, len(w))
        for j in range(len(w) - k + 1 if k else 0):
            wins[tuple(w[j:j + k])].add(i)
    for r in decontam.scan(docs.filter("doc_id is not null"), bench).collect():
        w, hit, found = words(ALNUM, odd_texts()[r.doc_id]), set(), set()
        for k in (1, 3, 10):
            for j in range(len(w) - k + 1):
                if got := wins.get(tuple(w[j:j + k])):
                    hit |= set(range(j, j + k))
                    found |= got
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (len(w), len(hit), len(found), digest, bool(hit))
    kept = decontam.remove_documents(docs, bench)
    assert kept.columns == docs.columns and kept.filter("doc_id = 5 or doc_id = 3").count() == 0 and kept.filter("doc_id = 4").count() == 1
    assert decontam.scan(docs, bench).count() == docs.count()
    assert decontam.scan(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert decontam.scan(none, bench).count() == 0
    assert decontam.spans(docs.filter("doc_id = 3"), bench).collect()[0][1:] == (0, 0)


def test_lm_counts_and_scores(spark, docs, none):
    out = lm.score(docs, F.col("doc_id") % 3 == 0).collect()
    rows = [(i, t) for i, t in enumerate(odd_texts())] + [(5, odd_texts()[5]), (None, odd_texts()[5])]
    tok = [(i, words(SPACED, t) + ["\0end"]) for i, t in rows]
    c = collections.Counter(w for i, ws in tok if i is None or i % 3 for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((-1 if i is None else i, len(ws), sum(c[w] > 0 for w in ws), n,
                   round(sum(np.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6)) for i, ws in tok)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want
    assert all(r.score < 0 for r in out)
    assert lm.score(none, F.lit(False)).count() == 0


def test_lm_learns_from_every_training_document(spark, monkeypatch):
    rows = [(i, f"text {i}") for i in range(40)] + [(7, "text 7"), (None, "no id"), (41, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    learned = []

    def seen(docs, tops, counts):
        learned.extend((r.doc_id, r.text) for r in docs.collect())
        return lm.Gru(counts).flat()

    monkeypatch.setattr(lm, "train", seen)
    lm.score(df, F.col("doc_id") % 3 == 0)
    key = lambda r: (r[0] or -1, r[1] or "")
    assert sorted(learned, key=key) == sorted((r for r in rows if r[0] is None or r[0] % 3), key=key)


def test_lm_state_is_carried_and_gradient_is_right():
    rng = np.random.default_rng(1)
    net = lm.Gru((np.full(lm.LEAST, 2.0), 10.0))
    net.p = {k: (v + rng.normal(0, 0.1, v.shape)).astype(np.float32) for k, v in net.p.items()}
    lens = np.array([1, 70, 33, 5])
    at = np.concatenate([[0], np.cumsum(lens)])
    ids = rng.integers(0, lm.LEAST + 1, at[-1]).astype(np.int32)
    got = lm.score_docs(net, ids, at, 0)
    for d in range(4):                                              # one token after the other
        s, prev, total = np.zeros((1, lm.HIDDEN), np.float32), 0, 0.0
        for y in ids[at[d]:at[d + 1]]:
            s = net.step(s, net.p["x"][[prev]])
            total += float(net.log_out(s, np.array([y]))[0])
            prev = y
        assert abs(total - got[d]) < 1e-3 * abs(total)
    # numeric gradient of the mean loss over one window
    xs, ys = rng.integers(0, lm.LEAST + lm.TAILS, (4, 3)), rng.integers(0, lm.LEAST + 3, (4, 3))
    xs[2] = xs[0]                                                   # inputs that repeat add up
    ok, new = np.ones((4, 3), bool), np.zeros((4, 3), bool)
    ok[3, 1], new[0], new[2, 2] = False, True, True                 # padding and a document's start
    begin = rng.normal(0, 0.5, (3, lm.HIDDEN)).astype(np.float32)

    def loss():
        s, total = begin, 0.0
        for x, y, o, n in zip(xs, ys, ok, new):
            s = net.step(np.where(n[:, None], 0, s), net.p["x"][x])
            total -= (net.log_out(s, y) * o).sum()
        return total / 11

    g, _ = net.grads(xs, ys, ok, new, begin)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    for k in ("u", "c", "cb", "x", "w", "wb"):
        i = np.unravel_index(int(np.abs(g[k]).argmax()), g[k].shape)
        old, eps = net.p[k][i], 1e-4
        net.p[k][i] = old + eps
        up = loss()
        net.p[k][i] = old - eps
        down = loss()
        net.p[k][i] = old
        assert abs((up - down) / (2 * eps) - g[k][i]) < 2e-3 + 0.02 * abs(g[k][i]), k


def test_lm_learns_from_every_token_once(monkeypatch):
    """Parts of documents in growing lanes: each token is a target once, after the token before it."""
    rng = np.random.default_rng(3)
    lens = np.array([5, 3000, 1, 40, 700, 2, 1500] * 3)
    at = np.concatenate([[0], np.cumsum(lens)])
    ids = rng.integers(0, lm.LEAST, at[-1]).astype(np.int32)
    net = lm.Gru((np.full(lm.LEAST, 2.0), 10.0))
    learner, got = lm.Learner(net, 7), []

    def seen(xs, ys, ok, new, s):
        got.extend(zip(xs[ok].tolist(), ys[ok].tolist()))
        return {k: np.zeros_like(v) for k, v in net.p.items()}, s

    monkeypatch.setattr(net, "grads", seen)
    monkeypatch.setattr(lm, "GROUP_STEPS", 2)
    learner.documents(ids, at)
    before = ids.copy()
    before[1:] = ids[:-1]
    before[at[:-1]] = 7
    assert collections.Counter(got) == collections.Counter(zip(before.tolist(), ids.tolist()))
    assert learner.lanes > lm.TRAIN_LANES


def test_pipeline_stages(spark, tmp_path):
    sys.path.insert(0, ".")
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows, cur = [docs.count()], docs
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, cur, SF_SMALL)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if k + 1 < len(P.STAGES):
            assert out.columns == docs.columns
        before = {r.doc_id for r in cur.select("doc_id").collect()}
        after = {r.doc_id for r in out.select("doc_id").collect()}
        assert after <= before
        rows.append(len(after))
        if name == "near_dedup":
            comp = brute_components([(r.doc_id, r.text) for r in cur.collect()], 80, 100)
            assert after == {i for i, (_, c) in comp.items() if c == i}
        cur = out
    assert rows[0] > rows[1] > rows[-1] > 0 and rows[-1] == rows[-2]
    assert P.run(spark, SF_SMALL).count() == rows[-1]
