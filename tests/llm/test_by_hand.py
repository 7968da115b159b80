"""Language profiles bound and bundled letter by letter, and the best labelling of small
trees by trying all of them."""

import itertools
import math
import random
import unicodedata

import numpy as np
from pyspark.sql import functions as F

from probity.llm import htmltext, langid

GAP = 0


def symbols(text):
    """Lower-cased letters as code points, one gap for anything else, gaps at both ends."""
    out = [GAP]
    for ch in text or "":
        if unicodedata.category(ch)[0] == "L":
            low = ch.lower()
            out.append(ord(low) if len(low) == 1 else ord(ch))
        elif out[-1] != GAP:
            out.append(GAP)
    return out if out[-1] == GAP else [*out, GAP]


def letter(code, memory={}):  # noqa: B006
    if code not in memory:
        memory[code] = langid.letter_vectors(np.array([code], np.uint32))[0].astype(int).tolist()
    return memory[code]


def rotated(v, k):
    return v[-k:] + v[:-k]


def bundle(text):
    """Sum of the bound trigrams that are centred on a letter."""
    s, total = symbols(text), [0] * langid.DIM
    for a, b, c in zip(s, s[1:], s[2:]):
        if b != GAP:
            bound = zip(rotated(letter(a), 2), rotated(letter(b), 1), letter(c))
            total = [t + x * y * z for t, (x, y, z) in zip(total, bound)]
    return total


def cosine(a, b):
    n = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
    return sum(x * y for x, y in zip(a, b)) / n if n else 0.0


def test_profiles_equal_binding_and_bundling_by_hand(spark):
    train = [("the cat and the dog", "en"), ("The END, of it", "en"), ("der Hund und die Katze", "de"), ("über Straßen", "de"),
             ("кот и собака", "ru"), (None, "ru"), ("no code", None), ("", "xx"), ("İstanbul ǅ", "tr")]
    ask = ["the end of the dog", "Die Straße", "СОБАКА", "123 ... !", None, "", "a", "x y  z", "the cat and the dog", "ДИЕ the"]
    rows = [(i, False, t, c) for i, (t, c) in enumerate(train)] + [(100 + i, True, t, None) for i, t in enumerate(ask)]
    rows += [rows[-1], (None, False, "the dog", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, held_out boolean, text string, lang string").repartition(3)
    model = langid.learn(docs.filter("not held_out and doc_id is not null"))
    proto = {}
    for t, c in train:
        if t is not None and c is not None:
            proto[c] = [x + y for x, y in zip(proto.get(c, [0] * langid.DIM), bundle(t))]
    assert model[0] == sorted(proto)
    got = langid.identify(docs, model).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    for i, t in enumerate(ask):
        v = bundle(t)
        scores = {c: cosine(v, p) for c, p in sorted(proto.items())}
        best = max(scores, key=scores.get) if any(v) else "und"
        for pred, score in by[100 + i]:
            assert pred == best and abs(score - (max(scores[best], 0.0) if any(v) else 0.0)) < 1e-5
    assert len(by[100 + len(ask) - 1]) == 2 and len(by[None]) == 1


def test_profiles_ignore_extra_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, True, "the cat", "en", "x", "y")],
                                 "doc_id long, held_out boolean, text string, lang string, score string, lang_pred string")
    out = langid.identify(docs, langid.learn(docs))
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"] and out.first().lang_pred == "en"
    empty = docs.limit(0)
    assert langid.learn(empty)[0] == [] and langid.identify(empty, langid.learn(empty)).count() == 0
    assert langid.identify(docs.withColumn("text", F.lit("no prototype")), langid.learn(empty)).first().lang_pred == "und"


def value(labels, margin):
    return sum(-math.log1p(math.exp(-m)) if k else -math.log1p(math.exp(m)) for k, m in zip(labels[1:], margin[1:]))


def test_decoding_is_the_best_of_all_labellings():
    rng = random.Random(8)
    for _ in range(150):
        n = rng.randint(1, 9)
        parent = [-1, *(rng.randrange(k) for k in range(1, n))]
        margin = np.array([rng.choice([-3.0, -0.5, 0.4, 2.5, rng.gauss(0, 2)]) for _ in range(n)])
        got = htmltext.decode(parent, margin).tolist()
        assert got[0] and all(got[parent[k]] or not got[k] for k in range(1, n))
        best = max(value(labels, margin) for labels in itertools.product([True], *[[False, True]] * (n - 1))
                   if all(labels[parent[k]] or not labels[k] for k in range(1, n)))
        assert abs(value(got, margin) - best) < 1e-9
