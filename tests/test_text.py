"""T1-T5 against a plain-Python statement of the same rules, on the fixture
documents and on edge texts (empty, accented, punctuation runs)."""

import hashlib
import itertools
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from probity.functions import text


# Fixed value: the characters that normalisation keeps besides word characters and spaces.
KEPT = "-+=/*()[]{}"


def py_normalize(s):
    """Lower case; every run of white space is one space; other signs vanish; ends trimmed."""
    out = []
    for ch in s.lower():
        if re.match(r"\s", ch):
            if not out or out[-1] is not None:
                out.append(None)        # a space of the source, one per run
        elif ch in KEPT or re.match(r"\w", ch):
            out.append(ch)
        else:
            out.append("")
    return "".join(" " if ch is None else ch for ch in out).strip()


def py_chunks(s, size=10):
    words = iter(py_normalize(s).split())
    digests = []
    while group := list(itertools.islice(words, size)):
        digests.append(hashlib.md5(" ".join(group).encode()).hexdigest()[:8])
    return digests


def py_structural(s):
    n = py_normalize(s)
    feat = f"{len(n)}-{len(n.split())}-{sum(c.isdigit() for c in n)}"
    return hashlib.md5(feat.encode()).hexdigest()[:16]


EDGE = ["", "   ", "Hello,   World!!", "Ça  déjà—vu? Ñandú (x+y)=z [a]{b} 42",
        "tabs\tand\nnewlines\r\nhere", "a , b", "one two three four five six seven eight nine ten eleven"]


@pytest.fixture(scope="module")
def texts(spark):
    docs = pq.read_table(f"{SF_CHECK}/documents.parquet", columns=["text"]).column(0).to_pylist()
    return docs[:300] + EDGE


def test_normalize_hash_chunks_match_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", text.normalize_text("t").alias("n"),
                     text.answer_hash("t").alias("h"), text.answer_hash("t", "md5").alias("m"),
                     text.chunk_hashes("t").alias("c"), text.fuzzy_hash("t").alias("f"),
                     text.structural_hash("t").alias("s")).collect()
    for r in rows:
        t = texts[r.i]
        n = py_normalize(t)
        assert r.n == n
        assert r.h == hashlib.sha256(n.encode()).hexdigest()
        assert r.m == hashlib.md5(n.encode()).hexdigest()
        assert list(r.c) == py_chunks(t)
        assert r.f == "-".join(py_chunks(t))
        assert r.s == py_structural(t)


def test_unsupported_algorithm():
    with pytest.raises(ValueError):
        text.answer_hash("t", "sha1")


def test_jaccard_edge_cases(spark):
    df = spark.createDataFrame([("", ""), ("a-b", "b-c"), ("a-b-a", "a-b")], "x string, y string")
    got = [r.j for r in df.select(text.jaccard_fuzzy("x", "y").alias("j")).collect()]
    assert got == [1.0, 1 / 3, 1.0]   # two empty hashes compare as [''] vs [''] (quirk Q17)


def test_similarity_of_equal_and_unrelated_answers(spark):
    one = ("Rivers carry sand downhill until the current slows; the load then settles, coarse grains "
           "first, and a fan of gravel grows where the valley opens onto the plain.")
    other = ("A kettle sings because steam bubbles collapse in the cooler water above the element, and "
             "the sound fades once all of the water is near boiling.")
    df = spark.createDataFrame([(one, one, other)], "a string, b string, c string")
    r = df.select(text.jaccard_fuzzy(text.fuzzy_hash("a"), text.fuzzy_hash("b")).alias("same"),
                  text.jaccard_fuzzy(text.fuzzy_hash("a"), text.fuzzy_hash("c")).alias("diff")).first()
    assert r.same == 1.0 and r.diff == 0.0


def test_has_words_equals_nonempty_normalisation(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select("i", text.has_words("t").alias("h"),
                       (F.size(text.words("t")) > 0).alias("w")).collect():
        assert r.h == r.w == bool(py_normalize(texts[r.i]).split())
