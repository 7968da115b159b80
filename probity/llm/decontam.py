"""Benchmark decontamination with DataFrame functions only.

The normalised n-grams of the test items form a hash set that is broadcast when
its counted rows allow it (``BROADCAST_ROWS``), and is a shuffled side otherwise.
Every window of a document probes that set by a 64-bit hash of its words; where the
hash is found, equality of the words decides, so a hit is verified as it is made and no
string is made of the other windows.  Only hits, and one row per document, are
shuffled, by document.

A window is ``WINDOW`` consecutive words of an item; an item of fewer words, but not
none, is one window.  Counts of hit words come from the union of the hit spans.

Defined cases: null texts have no words; items without words have no window; an
empty benchmark hits nothing; rows that share doc_id and text give one result
row each; null ids are compared as equal values; item ids that are null are
left out of the digest and count nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from probity.llm import nativewords as nw
from probity.llm.common import Scratch

WINDOW = 10
BROADCAST_ROWS = 500_000
KEY = ["doc_id", "tkey"]


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(win, k, item_id): the distinct windows of each item."""
    w = items.select("item_id", nw.words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    n = F.size("w")
    full = w.filter(n >= window).select("item_id", F.explode(nw.windows("w", window)).alias("x")).select(
        "x.win", "x.k", "item_id")
    short = w.filter(n < window).select(F.array_join("w", " ").alias("win"), n.alias("k"), "item_id")
    return full.union(short).distinct()


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW):
    """(per document and hit: doc_id, tkey, n_words, k, at, wid; windows with their items).

    A document without a hit has its k = 0 row only.
    """
    wins = item_windows(items, window)
    named = wins.select("win", "k", F.xxhash64("win").alias("wid")).distinct()
    sizes = sorted(r["k"] for r in named.select("k").distinct().collect())   # at most ``window`` values
    parts = F.split("win", " ")
    key = F.xxhash64(*[F.get(parts, F.lit(j)) for j in range(max(sizes, default=1))])        # skips the nulls after the last word
    alone = docs.sparkSession.createDataFrame([(nw.ALONE, 0, 0, nw.ALONE_KEY)], "win string, k int, wid long, key long")
    probe = named.select("win", "k", "wid", key.alias("key")).union(alone)
    if probe.count() <= BROADCAST_ROWS:
        probe = F.broadcast(probe)
    rows = nw.placed(docs, sizes)
    # not as an equality: that would become a join key and be computed for every window
    equal = F.when(F.col("k") == 0, F.col("size") == 0).otherwise(nw.window_of("x", "size", sizes) == F.col("win"))
    return rows.join(probe, (rows["key"] == probe["key"]) & equal).select("doc_id", "tkey", "n_words", "k", "at", "wid"), wins


def scan(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, tkey, n_words, n_hit, n_items, items_sha256, contaminated) per document."""
    found, wins = hits(docs, items, window)
    end = F.col("at") + F.col("k")
    w = Window.partitionBy(*KEY).orderBy("at", "k")
    before = F.coalesce(F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fresh = F.greatest(F.lit(0), end - F.greatest("at", before))
    # equal rows of ``documents`` repeat every hit; the k = 0 rows count them
    scratch = Scratch(docs.sparkSession, "decontam")
    per = (found.withColumn("fresh", fresh).groupBy(*KEY)
           .agg(F.max("n_words").alias("n_words"), F.sum("fresh").alias("n_hit"),
                F.sum(F.when(F.col("k") == 0, 1).otherwise(0)).cast("int").alias("copies"),
                F.collect_set(F.when(F.col("k") > 0, F.col("wid"))).alias("wids")))
    # written once: the texts are scanned a single time
    per = scratch.write(per.withColumn("hit_key", F.sha2(F.to_json(F.array_sort("wids")), 256)))
    # documents with the same hit windows share one list of items
    groups = per.filter(F.size("wids") > 0).groupBy("hit_key").agg(F.any_value("wids").alias("wids"))
    named = wins.filter("item_id is not null").select(F.xxhash64("win").alias("wid"), F.col("item_id").cast("string").alias("item"))
    items_of = (groups.select("hit_key", F.explode("wids").alias("wid")).join(named, "wid").select("hit_key", "item").distinct()
                .groupBy("hit_key").agg(F.array_sort(F.collect_list("item")).alias("items")))
    none = F.array().cast("array<string>")
    clean = per.filter(F.size("wids") == 0).drop("wids", "hit_key").withColumn("items", none)
    dirty = per.filter(F.size("wids") > 0).drop("wids").join(items_of, "hit_key", "left").drop("hit_key").withColumn(
        "items", F.coalesce("items", none))
    out = clean.unionByName(dirty).select(
        *KEY, F.col("n_words").cast("long").alias("n_words"), F.col("n_hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return out.drop("copy")


def remove_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a window of an item."""
    found, _ = hits(docs, items, window)
    bad = found.filter("k > 0").select(F.col("doc_id").alias("__hit_doc"), F.col("tkey").alias("__hit_key")).distinct()
    bad = Scratch(docs.sparkSession, "decontam").write(bad)
    if bad.count() <= BROADCAST_ROWS:                          # else every text is shuffled and sorted
        bad = F.broadcast(bad)
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("__hit_doc")) & (F.xxhash64("text") == F.col("__hit_key")), "left_anti")


def spans(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, first, last): the hit words of each document as maximal ranges."""
    found, _ = hits(docs, items, window)
    h = found.filter("k > 0").select("doc_id", "tkey", "at", (F.col("at") + F.col("k")).alias("end")).distinct()
    w = Window.partitionBy(*KEY).orderBy("at", "end")
    new = F.when(F.col("at") > F.coalesce(F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1)), 1).otherwise(0)
    return (h.withColumn("new", new).withColumn("run", F.sum("new").over(w)).groupBy(*KEY, "run")
            .agg(F.min("at").alias("first"), (F.max("end") - 1).alias("last")).drop("run", "tkey"))
