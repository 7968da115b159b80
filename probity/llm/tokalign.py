"""Alignment of two tokenizers' tokens over the same bytes, and corpus-wide link counts.

Both tokenizers encode space + text.  A text's tokens are divided at byte offsets
where both end a token: an interval of tokens looks for a common end near its
middle by bisecting the other tokenizer's ends, splits there, and its halves do
the same; an interval without one is a leaf, a group.  All intervals of a slice of
documents that are still open take each step together, in numpy; a probe that
finds no common end looks in a window four times as wide, so an interval is
searched at most a few times over before it becomes a leaf.

Links are the pairs of tokens that share a group.  Each task counts the documents
of every id pair before the counts are shuffled, so a pair that all documents hold
costs one row a task.  A document's distinct pairs are written once.  The counts go
back to them in two ways: at most ``HEAD`` most frequent pairs are broadcast, and
pairs that are not among them join by pair.  The bound is on the broadcast only; no
pair is dropped.

Texts are encoded chunk by chunk, cut where a space follows a non-space.  No match of
the byte-level split pattern and no piece of the other vocabulary spans such a place,
so the tokens are those of the whole text; whether the two tokenizers are like that is
looked up when they are loaded, and otherwise, or without such a place, a text is one
chunk.  A task encodes a chunk once and remembers up to ``REMEMBER`` of them.

Defined cases: a null or empty text, or one whose tokens of either kind do not join
to space + text, has no tokens: zeros and '' for the groups; every row is aligned and
counted by itself, so repeated rows count as often as they occur; a null doc_id is
kept; an empty table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probity.llm.common import Scratch

SLICE = 1 << 18
TOGETHER = 64
REMEMBER = 1 << 19
#: the space that a chunk after the first begins with; one at the end of a text stays with its word
CUT = re.compile(r"(?<=\S) (?!\Z)")
LINKS = 1 << 21
HEAD = 1 << 20
FLUSH = 1 << 20
_loaded: dict = {}


def byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary writes each byte: printable Latin-1
    characters stand for themselves, the other bytes take the letters from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Two tokenizers and the bytes of their ids."""

    def __init__(self, a_path: str, b_path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.na, self.nb = max(vocab.values()) + 1, self.b.get_piece_size()
        self.a_bytes = [b""] * self.na
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.nb)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        split = json.loads(self.a.to_str())
        self.cuttable = (split["normalizer"] is None and split["pre_tokenizer"] is not None
                         and split["pre_tokenizer"]["type"] == "ByteLevel" and split["pre_tokenizer"]["use_regex"]
                         and not any("▁" in p.lstrip("▁") for p in pieces))
        name = lambda n, end: [f"{i}{end}" for i in range(n)]
        self.forget()
        self.names = name(self.na, ",") + name(self.na, "|") + name(self.nb, ",") + name(self.nb, ";")

    def forget(self):
        """Chunk -> place; by place: whether the tokens join to space + chunk, ids and where they begin."""
        self.seen: dict[str, int] = {}
        self.whole = np.zeros(0, bool)
        self.ids = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.begin = [np.zeros(1, np.int64), np.zeros(1, np.int64)]

    def learn(self, chunks: list[str]):
        """Encode new chunks, ``TOGETHER`` of them as one text where the next one may follow."""
        lens = np.fromiter((len(c) if c.isascii() else len(c.encode()) for c in chunks), np.int64, len(chunks)) + 1
        blocks, at = [], 0
        for i, c in enumerate(chunks):
            if not self.cuttable or i - at == TOGETHER - 1 or not c or c[-1].isspace():
                blocks.append(" ".join(chunks[at:i + 1]))
                at = i + 1
        if at < len(chunks):
            blocks.append(" ".join(chunks[at:]))
        lists = ([x.ids for x in self.a.encode_batch_fast([" " + t for t in blocks], add_special_tokens=False)],
                 self.b.encode(blocks, num_threads=1))
        text = (" " + " ".join(chunks)).encode()
        ends = np.cumsum(lens)
        flat = [np.fromiter(itertools.chain.from_iterable(x), np.int32) for x in lists]
        ok = np.ones(len(chunks), bool)
        cuts = []
        for ids, names, size in zip(flat, (self.a_bytes, self.b_bytes), (self.a_len, self.b_len)):
            at = np.cumsum(size[ids])
            cuts.append(np.searchsorted(at, ends) + 1)
            if not len(at) or at[-1] != ends[-1] or not (at[np.minimum(cuts[-1], len(at)) - 1] == ends).all() or \
                    b"".join(map(names.__getitem__, ids.tolist())) != text:
                return self.learn_apart(chunks)
        self.remember(chunks, ok, flat, [np.diff(c, prepend=0) for c in cuts])

    def learn_apart(self, chunks: list[str]):
        """The same, chunk by chunk: some do not join to their bytes."""
        lists = ([x.ids for x in self.a.encode_batch_fast([" " + c for c in chunks], add_special_tokens=False)],
                 self.b.encode(chunks, num_threads=1))
        ok = [all(b"".join(map(names.__getitem__, x)) == (" " + c).encode() for names, x in ((self.a_bytes, xa), (self.b_bytes, xb)))
              for c, xa, xb in zip(chunks, *lists)]
        self.remember(chunks, np.array(ok, bool), [np.fromiter(itertools.chain.from_iterable(x), np.int32) for x in lists],
                      [np.fromiter(map(len, x), np.int64) for x in lists])

    def remember(self, chunks, ok, flat, counts):
        self.whole = np.concatenate([self.whole, ok])
        for k, (ids, n) in enumerate(zip(flat, counts)):
            self.begin[k] = np.concatenate([self.begin[k], self.begin[k][-1] + np.cumsum(n)])
            self.ids[k] = np.concatenate([self.ids[k], ids])
        self.seen.update(zip(chunks, range(len(self.seen), len(self.seen) + len(chunks))))

    def encode(self, texts: list[str]):
        """((ids, tokens by text) of either kind); none where they do not join to space + text."""
        if len(self.seen) > REMEMBER or max(map(len, self.ids)) > 16 * REMEMBER:
            self.forget()
        parts = [(CUT.split(t) if self.cuttable else [t]) if t else [] for t in texts]
        owner = np.repeat(np.arange(len(texts)), [len(x) for x in parts])
        chunks = list(itertools.chain.from_iterable(parts))
        new = list(dict.fromkeys(c for c in chunks if c not in self.seen))
        if new:
            self.learn(new)
        place = np.fromiter(map(self.seen.__getitem__, chunks), np.int64, len(chunks))
        out = []
        for k in (0, 1):
            first, count = self.begin[k][place], np.diff(self.begin[k])[place]
            which, at = _ranges(first, count)
            out.append((self.ids[k][at].astype(np.int64), owner[which]))
        bad = np.zeros(len(texts), bool)
        for i in np.unique(owner[~self.whole[place]]):     # a chunk may lack what its neighbour has
            t = (" " + texts[i]).encode()
            bad[i] = any(b"".join(map(n.__getitem__, ids[own == i].tolist())) != t
                         for n, (ids, own) in zip((self.a_bytes, self.b_bytes), out))
        return [(ids[~bad[own]], np.bincount(own[~bad[own]], minlength=len(texts))) for ids, own in out]


def pair(a_path: str, b_path: str) -> Pair:
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = Pair(a_path, b_path)
    return _loaded[a_path, b_path]


def _ranges(first: np.ndarray, count: np.ndarray):
    """(owner, value) of first[i], first[i] + 1, ... count[i] values each."""
    owner = np.repeat(np.arange(len(first)), count)
    begin = np.cumsum(count) - count
    return owner, np.arange(len(owner)) - np.repeat(begin - first, count)


def shared_ends(ea: np.ndarray, eb: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which of the ends ``ea`` close a group.

    ``ea`` and ``eb`` rise; document i has the tokens bounds[i] to bounds[i + 1] of
    ``ea``, and its last end is in ``eb`` as well.
    """
    close = np.zeros(len(ea), bool)
    lo, hi = bounds[:-1], bounds[1:]
    lo, hi = lo[hi > lo], hi[hi > lo]
    close[hi - 1] = True
    held = [np.zeros(0, np.int64)] * 3                   # intervals whose middle is no common end, and the next window
    while len(lo) or len(held[0]):
        inner = hi - lo >= 2                           # else a leaf: one token has no inner end
        lo, hi = lo[inner], hi[inner]
        mid = (lo + hi - 2) // 2
        end = ea[mid]
        found = eb[np.searchsorted(eb, end)] == end
        missed = ~found & (hi - lo > 2)                # with two tokens the middle was the only inner end
        cut, left, right = mid[found], lo[found], hi[found]
        wlo, whi, wide = held
        if len(wlo):
            mid = (wlo + whi - 2) // 2
            first = np.maximum(wlo, mid - wide)
            count = np.minimum(whi - 2, mid + wide) - first + 1
            owner, at = _ranges(first, count)
            end = ea[at]
            hit = eb[np.searchsorted(eb, end)] == end
            away = np.where(hit, 2 * np.abs(at - mid[owner]) + (at > mid[owner]), np.iinfo(np.int64).max)
            near = np.minimum.reduceat(away, np.cumsum(count) - count)
            found = near < np.iinfo(np.int64).max
            cut = np.concatenate([cut, (mid + np.where(near % 2 == 1, near // 2, -(near // 2)))[found]])
            left, right = np.concatenate([left, wlo[found]]), np.concatenate([right, whi[found]])
            again = ~found & ((first > wlo) | (first + count - 1 < whi - 2))     # the rest of the unfound are leaves
            wlo, whi, wide = wlo[again], whi[again], 4 * wide[again]
        close[cut] = True
        held = [np.concatenate([wlo, lo[missed]]), np.concatenate([whi, hi[missed]]),
                np.concatenate([wide, np.ones(int(missed.sum()), np.int64)])]
        lo, hi = np.concatenate([left, cut + 1]), np.concatenate([cut + 1, right])
    return close


def _add_up(key: np.ndarray, n: np.ndarray):
    """Distinct keys in order, with their sums of n."""
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    if not len(key):
        return key, n
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(n, first)


def _id_counts(g, ids, wanted, most: int):
    """(group, id, occurrences) of the tokens of the wanted groups."""
    m = wanted[g]
    key, n = _add_up(g[m].astype(np.int64) * most + ids[m], np.ones(int(m.sum()), np.int64))
    return key // most, key % most, n


def _group_pairs(ga, ia, gb, ib, p, q, na, nb):
    """Blocks of (group, pair id, links): the links of all groups."""
    large = p * q > LINKS // 64                        # few: there, equal ids are counted first
    for which in (~large, large):
        if not which.any():
            continue
        if which is large:
            xg, xa, xn = _id_counts(ga, ia, which, na)
            yg, yb, yn = _id_counts(gb, ib, which, nb)
            size = np.bincount(yg, minlength=len(q))
        else:
            xg, xa, xn = ga[which[ga]], ia[which[ga]], None
            yb, yn, size = ib[which[gb]], None, np.where(which, q, 0)
        begin, count = (np.cumsum(size) - size)[xg], size[xg]
        done = np.concatenate([[0], np.cumsum(count)])
        at = 0
        while at < len(xg):
            to = max(at + 1, int(np.searchsorted(done, done[at] + LINKS, "right")) - 1)
            owner, j = _ranges(begin[at:to], count[at:to])
            i = owner + at
            n = np.ones(len(i), np.int64) if xn is None else xn[i] * yn[j]
            yield xg[i], xa[i].astype(np.int64) * nb + yb[j], n
            at = to


def align(c: Pair, tokens):
    """For each text (n_a, n_b, n_groups, n_links, groups, pairs, links): the digest
    of the groups and the distinct linked id pairs with their number of links."""
    (ia, n_a), (ib, n_b) = tokens
    n = len(n_a)
    ea, eb = (np.cumsum(x, dtype=np.int32) for x in (c.a_len[ia], c.b_len[ib]))     # a slice or one text: below 2^31 bytes
    at_a, at_b = np.concatenate([[0], np.cumsum(n_a)]), np.concatenate([[0], np.cumsum(n_b)])
    close = shared_ends(ea, eb, at_a)
    ends = ea[close]
    ga = np.cumsum(close) - close
    gb = np.searchsorted(ends, eb)
    p, q = np.bincount(ga, minlength=len(ends)), np.bincount(gb, minlength=len(ends))
    doc = np.repeat(np.arange(n), n_a)[close]
    n_groups = np.bincount(doc, minlength=n)
    n_links = np.zeros(n, np.int64)
    np.add.at(n_links, doc, p * q)
    # group by group, A ids before B ids; the last of each kind ends in another sign
    before = np.cumsum(p + q) - (p + q)
    code = np.empty(len(ia) + len(ib), np.int64)
    first_a, first_b = np.cumsum(p) - p, np.cumsum(q) - q
    code[before[ga] + np.arange(len(ia)) - first_a[ga]] = ia + np.where(close, c.na, 0)
    last_b = np.concatenate([gb[1:] != gb[:-1], [True]]) if len(gb) else np.zeros(0, bool)
    code[before[gb] + p[gb] + np.arange(len(ib)) - first_b[gb]] = 2 * c.na + ib + np.where(last_b, c.nb, 0)
    at = at_a + at_b
    kinds = c.na * c.nb
    keys, links = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for g, key, m in _group_pairs(ga, ia, gb, ib, p, q, c.na, c.nb):
        key, m = _add_up(doc[g] * kinds + key, m)
        keys, links = (key, m) if not len(keys) else _add_up(np.concatenate([keys, key]), np.concatenate([links, m]))
    cut = np.searchsorted(keys, np.arange(n + 1) * kinds)
    for i in range(n):
        mine = slice(cut[i], cut[i + 1])
        name = "".join(map(c.names.__getitem__, code[at[i]:at[i + 1]].tolist()))[:-1]
        groups = hashlib.sha256(name.encode()).hexdigest() if name else ""
        yield int(n_a[i]), int(n_b[i]), int(n_groups[i]), int(n_links[i]), groups, keys[mine] - i * kinds, links[mine]


def pack(x: np.ndarray) -> bytes:
    """Rising or small numbers as compressed bytes."""
    return len(x).to_bytes(8, "little") + pa.compress(x.astype(np.int64).tobytes(), codec="zstd", asbytes=True)


def unpack(b: bytes) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    return np.frombuffer(pa.decompress(b[8:], 8 * n, codec="zstd", asbytes=True), np.int64) if n else np.zeros(0, np.int64)


FIELDS = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def _aligned(a_path, b_path, slice_chars):
    def run(batches):
        c = pair(a_path, b_path)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            at = 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and (to == at or size + len(texts[to]) <= slice_chars):
                    size += len(texts[to])
                    to += 1
                rows = list(align(c, c.encode(texts[at:to])))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(at, to - at), batch.column("doc_id").slice(at, to - at),
                     *(pa.array(x, pa.int64()) for x in cols[:4]), pa.array(cols[4], pa.string()),
                     pa.array([pack(np.diff(x, prepend=0)) for x in cols[5]], pa.binary()),
                     pa.array([pack(x) for x in cols[6]], pa.binary())],
                    names=["row", "doc_id", *FIELDS, "pairs", "links"])
                at = to

    return run


def _counted(batches):
    """(pair, n): in how many documents of the partition each pair is linked."""
    held, n, size = [], [], 0

    def out(key, count):
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(count)], names=["pair", "n"])

    for batch in batches:
        for b in batch.column("pairs"):
            held.append(np.cumsum(unpack(b.as_py())))
            n.append(np.ones(len(held[-1]), np.int64))
            size += len(held[-1])
            if size >= FLUSH:
                key, count = _add_up(np.concatenate(held), np.concatenate(n))
                held, n, size = [key], [count], len(key)
                if size > FLUSH // 2:
                    yield out(key, count)
                    held, n, size = [], [], 0
    if size:
        yield out(*_add_up(np.concatenate(held), np.concatenate(n)))


def link_counts(found: DataFrame, n_b: int) -> DataFrame:
    """(pair, a, n, best): documents that hold the pair linked, and whether no other pair of its A id has more."""
    total = found.select("pairs").mapInArrow(_counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return total.withColumn("a", F.expr(f"pair div {n_b}"))


def _scored(head):
    """Sums over the links whose pair is broadcast; the others leave as rows of their own."""
    def run(batches):
        key, count, best = head.value
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                row = part.column("row").to_numpy()
                pairs = [np.cumsum(unpack(b.as_py())) for b in part.column("pairs")]
                owner = np.repeat(np.arange(len(row)), [len(x) for x in pairs])
                x = np.concatenate(pairs)
                m = np.concatenate([unpack(b.as_py()) for b in part.column("links")])
                at = np.minimum(np.searchsorted(key, x), max(len(key) - 1, 0))
                known = key[at] == x if len(key) else np.zeros(len(x), bool)
                here, at = owner[known], at[known]
                total, top = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
                np.add.at(total, here, m[known] * count[at])
                np.add.at(top, here, m[known] * best[at])
                rest = ~known
                none = lambda n: pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row), pa.array(top), pa.array(total), none(len(row)), none(len(row))],
                    names=["row", "n_best", "count_sum", "pair", "m"])
                if rest.any():
                    k = int(rest.sum())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row[owner[rest]]), none(k), none(k), pa.array(x[rest]), pa.array(m[rest])],
                        names=["row", "n_best", "count_sum", "pair", "m"])

    return run


def alignment(docs: DataFrame, a_path: str, b_path: str, head: int = HEAD, slice_chars: int = SLICE) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per row of ``docs``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "align")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string").alias("text"))
    found = scratch.write(rows.mapInArrow(
        _aligned(a_path, b_path, slice_chars),
        f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, links binary"))
    counts = scratch.write(link_counts(found, pair(a_path, b_path).nb))
    most = F.broadcast(counts.groupBy("a").agg(F.max("n").alias("most")))    # a row per A id of the vocabulary
    counts = scratch.write(counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")))
    # the least power of two from which on the pairs are few enough for a broadcast
    power = F.floor(F.log2("n")).cast("int")
    sizes = counts.groupBy(power.alias("p")).agg(F.count("*").alias("k")).collect()      # 63 rows at most
    least, size = 63, 0
    for r in sorted(sizes, key=lambda r: -r["p"]):
        if size + r["k"] > head:
            break
        least, size = r["p"], size + r["k"]
    frequent = counts.filter(power >= least).toArrow()                        # ``head`` rows at most
    key = frequent.column("pair").to_numpy()
    order = np.argsort(key)
    value = (key[order], frequent.column("n").to_numpy()[order], frequent.column("best").to_numpy(zero_copy_only=False)[order])
    scored = found.select("row", "pairs", "links").mapInArrow(
        _scored(spark.sparkContext.broadcast(value)), "row long, n_best long, count_sum long, pair long, m long")
    if size < sum(r["k"] for r in sizes):
        scored = scratch.write(scored)
        tail = scored.filter("pair is not null").select("row", "pair", "m").join(counts.filter(power < least), "pair").select(
            "row", F.when(F.col("best"), F.col("m")).otherwise(0).alias("n_best"), (F.col("m") * F.col("n")).alias("count_sum"))
        scored = scored.filter("pair is null").select("row", "n_best", "count_sum").union(tail)
    sums = scored.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return found.select("row", "doc_id", *FIELDS).join(sums, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
