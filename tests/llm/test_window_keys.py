"""Windows of documents are probed by a hash of their words; no string is made of those that hit nothing."""

import re

from probity.llm import decontam

GAP = re.compile("[\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return [w for w in GAP.split(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


ITEMS = [("a", "one two three four five six seven eight nine ten eleven"), ("b", "Short item"), ("c", "lone"), ("d", None), ("e", " . "),
         ("f", "x y z"), (None, "null id")]
DOCS = [(1, "zero one two three four five six seven eight nine ten, twelve"), (2, "a short item here, x y z"), (3, "shortitem alone"), (4, None),
        (5, ""), (None, "LONE"), (7, "null id"), (7, "null id"), (8, "one two three four five six seven eight nine"), (9, "x y"), (10, "y z x y z lone")]


def hit_spans(text):
    w, found = words(text), set()
    for _, item in ITEMS:
        i = words(item)
        k = min(10, len(i))
        found |= {(at, k) for s in range(len(i) - k + 1) for at in range(len(w) - k + 1) if k and w[at:at + k] == i[s:s + k]}
    return found


def test_hits_equal_brute_force_for_all_sizes(spark):
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id string, text string")
    for n in (decontam.BROADCAST_ROWS, 0):
        old, decontam.BROADCAST_ROWS = decontam.BROADCAST_ROWS, n
        try:
            found = decontam.hits(docs, items)[0].collect()
            kept = decontam.remove_documents(docs, items)
            assert sorted(map(str, kept.collect())) == sorted(str(r) for r in docs.collect() if not hit_spans(r.text))
        finally:
            decontam.BROADCAST_ROWS = old
        want = sorted((str(d), len(words(t)), k, at) for d, t in DOCS for at, k in hit_spans(t) | {(0, 0)})
        assert sorted((str(r.doc_id), r.n_words, r.k, r.at) for r in found) == want


def test_windows_are_probed_by_hash(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS[:1], "item_id string, text string")
    plan = decontam.hits(docs, items)[0]._jdf.queryExecution().sparkPlan().toString()
    assert re.search(r"BroadcastHashJoin \[key#\d+L\], \[key#\d+L\]", plan)      # before: the window's string
    last = decontam.remove_documents(docs, items)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in last and "BroadcastHashJoin" in last
