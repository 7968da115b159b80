"""Property tests: the grid join equals a plain equi-join for any key skew
and any cell size; chunk hashes equal the plain-Python rule on random text."""

import itertools

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from probity.functions import text
from probity.operators.pairs import grid_join
from test_text import py_chunks

rows_strategy = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 30)),
                         min_size=0, max_size=60)


@settings(max_examples=12, deadline=None)
@given(left=rows_strategy, right=rows_strategy, cell=st.integers(1, 8), self_cond=st.booleans())
def test_grid_join_equals_plain_join(spark, left, right, cell, self_cond):
    lrows = [(k, i, v) for i, (k, v) in enumerate(left)]
    rrows = [(k, i, v) for i, (k, v) in enumerate(right)]
    L = spark.createDataFrame(lrows, "k string, li int, lv int")
    R = spark.createDataFrame(rrows, "k string, ri int, rv int")
    cond = (F.col("lv") < F.col("rv")) if self_cond else None
    got = sorted(tuple(r) for r in grid_join(L, R, ["k"], F.col("li"), F.col("ri"),
                                             condition=cond, cell_rows=cell)
                 .select("k", "li", "lv", "ri", "rv").collect())
    want = sorted((a[0], a[1], a[2], b[1], b[2]) for a, b in itertools.product(lrows, rrows)
                  if a[0] == b[0] and (not self_cond or a[2] < b[2]))
    assert got == want


words = st.lists(st.text(alphabet="abcdeé ÇXYZ,.!-+09\t\n", min_size=1, max_size=8), max_size=60)


@settings(max_examples=15, deadline=None)
@given(ws=words, size=st.integers(1, 12))
def test_chunk_hashes_match_python(spark, ws, size):
    s = " ".join(ws)
    got = spark.createDataFrame([(s,)], "t string").select(text.chunk_hashes("t", size).alias("c")).first().c
    assert list(got) == py_chunks(s, size)
