"""Near-duplicate answers by Jaccard similarity of chunk-hash sets.

Exact similarity join with prefix filtering (Chaudhuri, Ganti & Kaushik,
ICDE 2006; Bayardo, Ma & Srikant, WWW 2007): order each set's tokens by
global frequency, rarest first.  Two sets with Jaccard >= t must share a
token within the first ``|x| - ceil(t*|x|) + 1`` tokens of each, so only
these prefixes are joined.  Frequent tokens (boilerplate lines, junk, a
widely copied passage) sort last and rarely enter a prefix, which is what
keeps the candidate join from exploding on hot tokens.  Candidates are then
verified exactly on the full sets.

Documents with identical token sets are first collapsed to one
representative (the smallest id) per set; ``copy_classes`` returns that
mapping, so exact copies never generate pairs among themselves.  The whole
text is hashed (no chunk cap).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from probity.functions.text import chunk_hashes, has_words
from probity.operators.pairs import DEFAULT_CELL_ROWS, grid_join
from probity.session import materialize

EPS = 1e-9


def token_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               chunk_size: int = 10) -> DataFrame:
    """(id, toks): sorted distinct chunk hashes (full md5) of each non-empty text.

    Empty texts are dropped by a cheap test on the raw text: a filter on
    ``size(toks)`` would be pushed below the projection and hash every text
    twice."""
    toks = F.array_sort(F.array_distinct(chunk_hashes(text_col, chunk_size, 32)))
    return (docs.filter(has_words(text_col))
            .select(F.col(id_col).alias("id"), toks.alias("toks")))


def copy_classes(sets: DataFrame) -> DataFrame:
    """(id, representative, copies): documents grouped by identical token set."""
    sig = F.sha2(F.array_join("toks", ","), 256)
    s = sets.select("id", sig.alias("sig"))
    reps = s.groupBy("sig").agg(F.min("id").alias("representative"),
                                F.count(F.lit(1)).alias("copies"))
    return s.join(reps, "sig").select("id", "representative", "copies")


def representatives(sets: DataFrame) -> DataFrame:
    """One row per distinct token set: (id = smallest id, toks)."""
    sig = F.sha2(F.array_join("toks", ","), 256)
    return (sets.groupBy(sig.alias("sig"))
            .agg(F.min_by("toks", "id").alias("toks"), F.min("id").alias("id"))
            .select("id", "toks"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    min_jaccard: float = 0.8, chunk_size: int = 10,
                    cell_rows: int = DEFAULT_CELL_ROWS) -> DataFrame:
    """(doc_a, doc_b, jaccard) for distinct token sets with Jaccard >= t, a < b."""
    t = float(min_jaccard)
    # hashing the corpus is the expensive step and three branches reuse it
    reps = materialize(representatives(token_sets(docs, id_col, text_col, chunk_size)),
                       "token-sets")
    reps = reps.withColumn("n", F.size("toks"))
    tok = reps.select("id", "n", F.explode("toks").alias("tok"))
    freq = tok.groupBy("tok").agg(F.count(F.lit(1)).alias("df"))
    w = Window.partitionBy("id").orderBy("df", "tok")
    prefix_len = F.col("n") - F.ceil(F.col("n") * t - EPS) + 1
    pre = (tok.join(freq, "tok")
           .withColumn("rk", F.row_number().over(w))
           .filter(F.col("rk") <= prefix_len)
           .select("tok", "id", "n"))
    # both sides and the hot-key count read the prefixes: computed once
    pre = materialize(pre, "prefixes")
    a = pre.select("tok", F.col("id").alias("id_a"), F.col("n").alias("n_a"))
    b = pre.select("tok", F.col("id").alias("id_b"), F.col("n").alias("n_b"))
    size_ok = ((F.col("id_a") < F.col("id_b"))
               & (F.col("n_b") >= F.col("n_a") * t - EPS)
               & (F.col("n_a") >= F.col("n_b") * t - EPS))
    cand = (grid_join(a, b, ["tok"], F.col("id_a"), F.col("id_b"), condition=size_ok,
                      cell_rows=cell_rows, self_join=True)
            .select("id_a", "id_b").distinct())
    ra = reps.select(F.col("id").alias("id_a"), F.col("toks").alias("t_a"), F.col("n").alias("n_a"))
    rb = reps.select(F.col("id").alias("id_b"), F.col("toks").alias("t_b"), F.col("n").alias("n_b"))
    both = F.size(F.array_intersect("t_a", "t_b"))
    v = cand.join(ra, "id_a").join(rb, "id_b")
    return (v.select(F.col("id_a").alias("doc_a"), F.col("id_b").alias("doc_b"),
                     (both / (F.col("n_a") + F.col("n_b") - both)).alias("jaccard"))
            .filter(F.col("jaccard") >= t))
