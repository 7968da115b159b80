"""Exact de-duplication by deterministic block naming, in DataFrame functions only.

A text without white space is cut into blocks of ``BLOCK`` bytes.  The distinct
blocks are sorted, and a block's place becomes its integer name; then adjacent
names are paired, the distinct pairs are sorted and named in turn, and so on
until one name is left for each document.  Two documents have the same name of
the same level if and only if their texts are equal: names are given to
compared blocks and pairs, never to digests.

A name finds its way back to a block by two 64-bit hashes of the block instead
of its bytes, so block bytes are shuffled once.  Whether the two hashes tell all
distinct blocks apart is counted, and if they do not, the work starts again with
other seeds.

Scale: only distinct blocks are sorted and shuffled as bytes, after a partial
aggregation, so a block that a third of all rows hold costs one row a task.  All
later rows are a few integers.  The levels are log2 of the longest text's blocks;
a document leaves the loop as soon as it has one name.  Joins read written
tables on both sides, so a frequent name can be split at run time.

Defined cases: a null text counts as empty, and all empty texts are equal; every
row is a document of its own, so equal rows form a group of which one stays; a
null doc_id loses against any other among texts of the same length; an empty
table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probity.llm.common import Scratch

BLOCK = 1024
SPACE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without [\\x20\\x09-\\x0D]; null counts as empty."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for c in SPACE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def _blocks(docs: DataFrame, cols: list, seed: int, size: int) -> DataFrame:
    """One row per document and block: ``cols``, idx, block and its two hashes."""
    body = docs.select(*cols, normalised(F.col("text")).cast("binary").alias("__body"))
    n = F.greatest(F.ceil(F.octet_length("__body") / size), F.lit(1)).cast("int")
    rows = body.select("*", n.alias("n_blocks"), F.explode(F.sequence(F.lit(0), n - 1)).alias("idx"))
    block = F.substring("__body", F.col("idx") * size + 1, F.lit(size))
    hashes = [F.xxhash64(F.lit(2 * seed + i), block).alias(f"k{i}") for i in (1, 2)]
    return rows.select(*[c for c in rows.columns if c != "__body"], block.alias("block"), *hashes)


def _named(scratch: Scratch, things: DataFrame, by: list[str], carry: list[str]) -> DataFrame:
    """Names of the distinct rows of ``things``: their places when sorted by ``by``.

    Rows are sorted within their hash partition and the partition's number leads
    the name, so no task sorts more than its share.  Written once: the names do
    not change when a task is repeated.
    """
    order = things.distinct().sortWithinPartitions(*by)
    return scratch.write(order.select(*carry, (F.monotonically_increasing_id() + 1).alias("name")))


def _first_names(docs, scratch, size, seeds):
    """(row, n_blocks, idx, name) of every block, and the row with doc_id, n_chars and text_sha256 of each document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    ids = [F.monotonically_increasing_id().alias("row"), "doc_id", F.char_length(text).cast("long").alias("n_chars")]
    for seed in seeds:
        rows = _blocks(docs, [*ids, F.sha2(normalised(F.col("text")), 256).alias("sha")], seed, size)
        head = lambda c: F.when(F.col("idx") == 0, F.col(c)).alias(c)
        held = scratch.write(rows.select("row", "n_blocks", "idx", "k1", "k2", head("doc_id"), head("n_chars"), head("sha")))
        names = _named(scratch, _blocks(docs, [], seed, size).select("k1", "k2", "block"), ["block"], ["k1", "k2"])
        if names.select("k1", "k2").distinct().count() == names.count():
            return held, names
        scratch.drop(held)
        scratch.drop(names)
    raise RuntimeError("blocks share both hashes under every seed")


def identities(docs: DataFrame, size: int = BLOCK, seeds=range(1, 9)) -> DataFrame:
    """(row, doc_id, n_chars, text_sha256, level, name): level and name together are the
    identity of the text without white space.  ``row`` numbers the rows of ``docs``."""
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    held, names = _first_names(docs, scratch, size, seeds)
    level = scratch.write(held.join(names, ["k1", "k2"]).select("row", "n_blocks", "idx", "name"))
    most = held.agg(F.max("n_blocks")).first()[0] or 1
    done, depth = [], 0
    while True:
        whole = F.col("n_blocks") <= (1 << depth)
        done.append(level.filter(whole).select("row", F.lit(depth).alias("level"), "name"))
        if most <= (1 << depth):
            break
        half = F.expr("idx % 2")
        pairs = level.filter(~whole).groupBy("row", F.expr("idx div 2").cast("int").alias("idx")).agg(
            F.max("n_blocks").alias("n_blocks"), F.max(F.when(half == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(half == 1, F.col("name"))), F.lit(0)).alias("b"))
        pairs = scratch.write(pairs)
        names = _named(scratch, pairs.select("a", "b"), ["a", "b"], ["a", "b"])
        level = scratch.write(pairs.join(names, ["a", "b"]).select("row", "n_blocks", "idx", "name"))
        scratch.drop(pairs)
        scratch.drop(names)
        depth += 1
    every = done[0]
    for part in done[1:]:
        every = every.union(part)
    heads = held.filter("idx = 0").select("row", "doc_id", "n_chars", F.col("sha").alias("text_sha256"))
    return scratch.write(heads.join(every, "row"))


def exact_duplicates(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.

    Of equal texts the one with the most code points stays, then the one of
    least doc_id, then the first row.
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup-groups")
    found = identities(docs, size)
    rank = F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), "doc_id", "row")
    groups = scratch.write(found.groupBy("level", "name").agg(
        F.min(rank).alias("best"), F.count("*").alias("group_size")).select(
        "level", "name", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size"))
    return found.join(groups, ["level", "name"]).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` without those whose text an earlier choice already holds.

    A group of rows that share both doc_id and text keeps all of its rows."""
    gone = exact_duplicates(docs, size).groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("__stay")).filter(
        "not __stay").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"))
    sha = F.sha2(normalised(docs["text"]), 256)
    return docs.join(gone, docs["doc_id"].eqNullSafe(F.col("__id")) & (sha == F.col("__sha")), "left_anti")
