"""Byte-level BPE over a tree of text halves.

Encoding is a monoid: a leaf is encoded by the merges, and two neighbours are
joined by re-encoding a window around the border.  The window grows until both
its ends are places that no later or earlier character can move:

* a border between a non-space and a following space character, or
* a border between a letter and a following digit, or a digit and a letter.

The split pattern looks at no character before a match, and no alternative of
it spans such a border, so the text before and the text after are encoded
independently and the tokens outside the window are final.  Where neither side
has such a place the window becomes the whole of both halves.

Decoding concatenates the tokens' bytes, half by half, up the same tree.

Defined cases: a null text is an empty one; it has no token.  Every row is
encoded whole and alone, so repeated rows and ids give repeated results.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame

LEAF = 1 << 14
WINDOW = 64
#: characters that are white space by every definition
SPACES = frozenset(" \t\n\r\x0b\x0c")
_loaded: dict[str, "Coder"] = {}


def _kind(c: str) -> int:
    """0 white space, 1 letter, 2 digit, 3 other; as far as a stable border needs it."""
    if c.isspace():
        return 0
    if c.isascii():
        return 1 if c.isalpha() else 2 if c.isdigit() else 3
    return 3


def stable(text: str, p: int) -> bool:
    """No match of the pattern spans p and none depends on what is beyond it."""
    a, b = _kind(text[p - 1]), _kind(text[p])
    return (a != 0 and text[p] in SPACES) or (a, b) in ((1, 2), (2, 1))


class Coder:
    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.enc = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.names = [str(i) for i in range(max(ranks.values(), default=-1) + 1)]

    def leaf(self, text: str) -> list[int]:
        return self.enc.encode_ordinary(text)

    def encode(self, text: str, leaf: int = LEAF) -> list[int]:
        return self.tree(text, 0, len(text), leaf)

    def tree(self, text: str, lo: int, hi: int, leaf: int) -> list[int]:
        if hi - lo <= leaf:
            return self.leaf(text[lo:hi])
        mid = (lo + hi) // 2
        return self.join(text, lo, mid, hi, self.tree(text, lo, mid, leaf), self.tree(text, mid, hi, leaf))

    def join(self, text, lo, mid, hi, left, right):
        if stable(text, mid):
            return left + right
        a, b = self.grow(text, lo, mid, -1), self.grow(text, hi, mid, 1)
        head = self.cut(left, text[a:mid], True)
        tail = self.cut(right, text[mid:b], False)
        return left[:head] + self.leaf(text[a:b]) + right[tail:]

    @staticmethod
    def grow(text, end, mid, step):
        """The nearest stable place on one side of mid, in doubling windows; else the end."""
        size, p = WINDOW, mid
        while p != end:
            stop = max(end, mid - size) if step < 0 else min(end, mid + size)
            while p != stop:
                p += step
                if p != end and stable(text, p):
                    return p
            size *= 2
        return end

    def cut(self, ids, part, from_end: bool) -> int:
        """Where the tokens of ``part``, at one end of ``ids``, begin or end."""
        need = len(part.encode("utf-8"))
        if from_end:
            k = len(ids)
            while need > 0:
                k -= 1
                need -= len(self.bytes_of[ids[k]])
            return k
        k = 0
        while need > 0:
            need -= len(self.bytes_of[ids[k]])
            k += 1
        return k

    def decode(self, ids, lo=0, hi=None) -> bytes:
        hi = len(ids) if hi is None else hi
        if hi - lo <= LEAF:
            return self.enc.decode_bytes(ids[lo:hi])
        mid = (lo + hi) // 2
        return self.decode(ids, lo, mid) + self.decode(ids, mid, hi)


def coder(path: str, pattern: str) -> Coder:
    if path not in _loaded:
        _loaded[path] = Coder(path, pattern)
    return _loaded[path]


def digests(path: str, pattern: str):
    def run(batches):
        c = coder(path, pattern)
        name = c.names.__getitem__
        for batch in batches:
            n, ids_sha, dec_sha = [], [], []
            for t in batch.column("text"):
                ids = c.encode(t.as_py() or "")
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join(map(name, ids)).encode()).hexdigest())
                dec_sha.append(hashlib.sha256(c.decode(ids)).hexdigest())
            keep = [x for x in batch.schema.names if x != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in keep), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(dec_sha, pa.string())], names=[*keep, "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def tokens(path: str, pattern: str):
    def run(batches):
        c = coder(path, pattern)
        for batch in batches:
            ids, text = [], []
            for t in batch.column("text"):
                ids.append(c.encode(t.as_py() or ""))
                text.append(c.decode(ids[-1]).decode("utf-8"))
            keep = [x for x in batch.schema.names if x != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in keep), pa.array(ids, pa.list_(pa.int32())), pa.array(text, pa.string())],
                names=[*keep, "ids", "decoded"])

    return run


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """(key, ids, decoded): the tokens of each text and the text they decode to."""
    return docs.select(key, "text").mapInArrow(
        tokens(path, pattern), f"{key} {docs.schema[key].dataType.simpleString()}, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256), without moving the tokens out of the task."""
    return docs.select(key, "text").mapInArrow(
        digests(path, pattern), f"{key} {docs.schema[key].dataType.simpleString()}, n_tokens long, "
        "ids_sha256 string, decoded_sha256 string")
