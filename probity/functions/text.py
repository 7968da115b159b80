"""Answer-text normalisation and hashing as column expressions.

No Python UDF: every function composes built-in JVM expressions (regex,
``split``, higher-order ``transform``/``filter``, ``md5``/``sha2``), so it runs
inside whole-stage codegen on whole texts of any length.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (T1): the whitespace set of Python's str.isspace (ASCII controls
# plus the Unicode separator category) and the punctuation kept by the
# normaliser: word characters, space and - + = / * ( ) [ ] { }.
WHITESPACE_RUN = r"[\t\n\x0B\f\r\x1C-\x1F\x{85}\p{Z}]+"
DROPPED_CHARS = r"[^\p{L}\p{N}_ \-+=/*()\[\]{}]"


# A text has at least one word after normalisation iff it holds one of these.
KEPT_CHAR = r"[\p{L}\p{N}_\-+=/*()\[\]{}]"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(c: Column | str) -> Column:
    """Lower-case, collapse whitespace runs to one space, drop punctuation
    (keeping ``- + = / * ( ) [ ] { }``), strip the ends."""
    x = F.lower(_c(c))
    x = F.regexp_replace(x, WHITESPACE_RUN, " ")
    x = F.regexp_replace(x, DROPPED_CHARS, "")
    return F.trim(x)


def answer_hash(c: Column | str, algorithm: str = "sha256") -> Column:
    """Hex digest of the normalised text (sha256 or md5)."""
    n = normalize_text(c)
    if algorithm == "sha256":
        return F.sha2(n, 256)
    if algorithm == "md5":
        return F.md5(n)
    raise ValueError(f"no such digest: {algorithm!r} (sha256 or md5)")


def has_words(c: Column | str) -> Column:
    """Cheap test on the raw text: does normalisation leave any word?"""
    return _c(c).rlike(KEPT_CHAR)


def words(c: Column | str) -> Column:
    """Whitespace-separated words of the normalised text (empty text -> [])."""
    return F.filter(F.split(normalize_text(c), " "), lambda w: w != "")


def chunks(c: Column | str, chunk_size: int = 10) -> Column:
    """Consecutive ``chunk_size``-word chunks of the normalised text, each
    re-joined with single spaces.  One greedy regex pass over the text, so
    the cost is linear in its length."""
    pattern = rf"[^ ]+(?: +[^ ]+){{0,{chunk_size - 1}}}"
    found = F.regexp_extract_all(normalize_text(c), F.lit(pattern), 0)
    # dropped punctuation between two spaces leaves a double space; only
    # those (rare) chunks need re-joining with single spaces
    return F.transform(found, lambda ch: F.when(F.instr(ch, "  ") > 0,
                                                F.regexp_replace(ch, " +", " ")).otherwise(ch))


def chunk_hashes(c: Column | str, chunk_size: int = 10, digits: int = 8) -> Column:
    """Array of md5 prefixes of ``digits`` hex digits, one per ``chunk_size``-word
    chunk of the whole text.  8 digits make the fuzzy hash; joins over a corpus
    take all 32."""
    return F.transform(chunks(c, chunk_size), lambda x: F.substring(F.md5(x), 1, digits))


def fuzzy_hash(c: Column | str, chunk_size: int = 10) -> Column:
    """Chunk hashes joined by ``-`` (``''`` for an empty text)."""
    return F.array_join(chunk_hashes(c, chunk_size), "-")


def jaccard_fuzzy(a: Column | str, b: Column | str) -> Column:
    """T4: Jaccard similarity of the two fuzzy hashes' chunk sets.

    ``''.split('-')`` is ``['']``, so two empty texts score 1.0.
    """
    sa, sb = F.split(_c(a), "-"), F.split(_c(b), "-")
    return F.size(F.array_intersect(sa, sb)) / F.size(F.array_union(sa, sb))


def structural_hash(c: Column | str) -> Column:
    """T5: md5 prefix 16 of ``length-words-digits`` of the normalised text."""
    n = normalize_text(c)
    feat = F.concat_ws("-", F.length(n).cast("string"),
                       F.size(F.filter(F.split(n, " "), lambda w: w != "")).cast("string"),
                       F.regexp_count(n, F.lit(r"\p{Nd}")).cast("string"))
    return F.substring(F.md5(feat), 1, 16)
