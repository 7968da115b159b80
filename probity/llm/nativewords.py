"""Word arrays in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from probity.llm.common import ascii_lower

#: what separates words once A-Z is lower-cased
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: a key no window of words can equal; each document has one row with it
ALONE = "\u0000"
ALONE_KEY = 0


def words(text: Column) -> Column:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the lower-cased text; null has none."""
    return F.array_remove(F.split(ascii_lower(text), GAP), "")


def windows(w: str, k: int) -> Column:
    """(k, at, win) for every k consecutive words of array column ``w``."""
    n = F.size(w)
    one = lambda i: F.struct(F.lit(k).alias("k"), i.alias("at"),
                             F.array_join(F.slice(w, i + 1, k), " ").alias("win"))
    none = F.array().cast("array<struct<k:int,at:int,win:string>>")
    return F.when(n >= k, F.transform(F.sequence(F.lit(0), n - k), one)).otherwise(none)


def placed(docs, sizes) -> "DataFrame":  # noqa: F821
    """One row per document, word and size: (doc_id, tkey, n_words, at, size, key, x).

    ``key`` hashes the window of ``size`` words that begins at word ``at``; its words are ``x.c0``,
    ``x.c1``, ... (``window_of``), and no string is made of them here.  ``tkey`` hashes the
    text, so rows that share a doc_id stay apart unless they are equal.  A row of size 0 and ``ALONE_KEY`` stands for
    the document itself.
    """
    sizes = sorted(sizes) or [1]
    cols = [f"c{j}" for j in range(sizes[-1])]
    base = docs.select("doc_id", F.xxhash64("text").alias("tkey"), F.concat(F.array(F.lit(ALONE)), words(F.col("text"))).alias("w"))
    base = base.select("doc_id", "tkey", (F.size("w") - 1).cast("long").alias("n_words"), F.col("w").alias("c0"),
                       *[F.slice("w", j + 1, F.size("w")).alias(c) for j, c in enumerate(cols) if j])
    rows = base.select("doc_id", "tkey", "n_words", F.posexplode(F.arrays_zip(*cols)).alias("at", "x"))
    alone = F.col("at") == 0                                   # the word before the first one
    one = lambda k: F.struct(F.when(alone, 0).otherwise(k).alias("size"),
                             F.when(alone, F.lit(ALONE_KEY)).otherwise(F.xxhash64(*[F.col(f"x.{c}") for c in cols[:k]])).alias("key"))
    fits = lambda k: F.col(f"x.{cols[k - 1]}").isNotNull()
    if len(sizes) == 1:
        rows = rows.filter(alone | fits(sizes[0])).withColumn("y", one(sizes[0]))
    else:
        some = F.array(*[F.when((alone & F.lit(k == sizes[0])) | (~alone & fits(k)), one(k)) for k in sizes])
        rows = rows.withColumn("y", F.explode(some)).filter("y is not null")
    return rows.select("doc_id", "tkey", "n_words", F.greatest(F.col("at") - 1, F.lit(0)).alias("at"), "y.size", "y.key", "x")


def window_of(x: str, size: str, sizes) -> Column:
    """The words of a row of ``placed`` as one string."""
    out = F.lit(ALONE)
    for k in sizes:
        out = F.when(F.col(size) == k, F.concat_ws(" ", *[F.col(f"{x}.c{j}") for j in range(k)])).otherwise(out)
    return out


def spread(docs, sizes) -> "DataFrame":  # noqa: F821
    """One row per document and window: (doc_id, tkey, n_words, k, at, win).

    ``tkey`` hashes the text, so rows that share a doc_id stay apart unless they are
    equal.  A row with k = 0 and win = ``ALONE`` stands for the document itself.
    """
    base = docs.select("doc_id", F.xxhash64("text").alias("tkey"), words(F.col("text")).alias("w"))
    alone = F.array(F.struct(F.lit(0).alias("k"), F.lit(0).alias("at"), F.lit(ALONE).alias("win")))
    every = F.concat(alone, *[windows("w", k) for k in sizes])
    return base.select("doc_id", "tkey", F.size("w").cast("long").alias("n_words"), F.explode(every).alias("x")).select(
        "doc_id", "tkey", "n_words", "x.k", "x.at", "x.win")
