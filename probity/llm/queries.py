"""The queries of this package: name -> (builder, oracle SQL or None)."""

from __future__ import annotations

from pyspark.sql import functions as F

from probity.llm import (balltree, bpe, decontam, exactdedup, htmltext, langid, licenses, linededup, lm, minhash, tokalign,
                         toxicity, whitening)
from probity.llm.common import id_crc, table

#: rank file of the public tokenizer, by the name that public_tokenizers knows
RANKS = "byte_bpe_multi_50k.tiktoken"
#: the two tokenizers that op13 aligns
BYTE_BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def tokenizer(name: str = RANKS):
    import public_tokenizers
    return public_tokenizers.path(name), public_tokenizers.PATTERN


def _rest(docs, mod: int, rem: int):
    return F.coalesce(id_crc(docs["doc_id"]) % mod == rem, F.lit(False))


def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    docs = docs.withColumn("held_out", _rest(docs, 4, 2))
    model = langid.learn(docs.filter("not held_out and doc_id is not null"))
    return langid.identify(docs, model)


def op2_minhash_near_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), 85, 100)


def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op4_byte_bpe(spark, sf_dir):
    return bpe.encode_digests(table(spark, sf_dir, "documents"), *tokenizer())


def op5_line_dedup(spark, sf_dir):
    return linededup.line_report(table(spark, sf_dir, "documents"))


def op6_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_exact_top_k(spark, sf_dir):
    every = balltree.quantised(table(spark, sf_dir, "embeddings"))
    return balltree.top_k(every, every.filter(F.col("vec_id") % 50 == 0), 5)


def op8_html_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return htmltext.main_text(pages, htmltext.train(pages))


def op9_decontamination(spark, sf_dir):
    return decontam.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("tkey")


def op10_lm_score(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = lm.score(docs, id_crc(docs["doc_id"]) % 10 == 0)
    return out.select("doc_id", _rest(out, 10, 0).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score")


def op11_exact_dedup(spark, sf_dir):
    return exactdedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_tokenizer_alignment(spark, sf_dir):
    return tokalign.alignment(table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE)[0], tokenizer(PIECES)[0])


def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_minhash_near_dedup, op3_toxicity, op4_byte_bpe, op5_line_dedup, op6_license_scan,
    op7_exact_top_k, op8_html_extraction, op9_decontamination, op10_lm_score, op11_exact_dedup,
    op12_embedding_whitening, op13_tokenizer_alignment, pipeline)}


def _words_sql(x: str) -> str:
    low = f"translate(coalesce({x}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({low}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


_OP2 = """
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s FROM w),
x AS MATERIALIZED (SELECT doc_id, md5(unnest(s)) AS h FROM s),
n AS MATERIALIZED (SELECT doc_id, len(s) AS n FROM s),
l AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.h = b.h AND a.doc_id < b.doc_id
      GROUP BY 1, 2
      HAVING 100 * count(*) >= 85 * ((SELECT n FROM n WHERE doc_id = a.doc_id) + (SELECT n FROM n WHERE doc_id = b.doc_id) - count(*))),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (WITH RECURSIVE r(id, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.id)
      SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, r.c AS component_id, n.doc_id = r.c AS kept FROM n JOIN r ON r.id = n.doc_id"""

_OP7 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score,
         CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id) AS INTEGER) AS rank
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0) t
WHERE rank <= 5"""

_OP9 = f"""
WITH b AS (SELECT item_id, {_words_sql("text")} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS k,
         array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win
       FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) t(i) WHERE len(w) > 0),
k AS (SELECT DISTINCT k FROM bw),
d AS (SELECT doc_id, {_words_sql("text")} AS w FROM documents),
dw AS (SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS win FROM d, k, unnest(range(1, len(w) - k + 2)) t(i)),
h AS (SELECT DISTINCT dw.doc_id, dw.k, dw.i, bw.item_id FROM dw JOIN bw USING (win, k)),
p AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) x GROUP BY 1),
m AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
             array_to_string(list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))), ',') AS items FROM h GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN m USING (doc_id)"""


def _op6_sql() -> str:
    rows = ", ".join(f"('{p}', {t}, {i}, {n}, '{lab}', {str(base).lower()})" for p, t, i, n, lab, base in licenses.templates())
    return f"""
WITH t(pair, tid, tpos, pairs, label, base) AS (VALUES {rows}),
d AS (SELECT doc_id, {_words_sql("text")} AS w FROM documents),
g AS (SELECT doc_id, i - 1 AS pos, w[i] || ' ' || w[i + 1] AS pair FROM d, unnest(range(1, len(w))) x(i)),
v AS (SELECT doc_id, tid, pos - tpos AS diag, list(DISTINCT tpos) AS ps, any_value(pairs) AS pairs, any_value(label) AS label,
             any_value(base) AS base FROM g JOIN t USING (pair) GROUP BY 1, 2, 3),
z AS (SELECT v.doc_id, v.tid, v.diag, any_value(v.pairs) AS pairs, any_value(v.label) AS label, any_value(v.base) AS base,
             any_value(len(v.ps)) AS votes, len(list_distinct(flatten(list(o.ps)))) AS merged
      FROM v JOIN v o ON o.doc_id = v.doc_id AND o.tid = v.tid AND o.diag BETWEEN v.diag - {licenses.DRIFT} AND v.diag + {licenses.DRIFT}
      GROUP BY 1, 2, 3),
c AS (SELECT *, base AND votes = pairs AS place, CASE WHEN base THEN CASE WHEN votes = pairs THEN 1.0::DOUBLE ELSE 0.0 END
             ELSE CAST(merged AS DOUBLE) / pairs END AS cover FROM z),
a AS (SELECT doc_id, count(*) FILTER (place) AS n_base, min(diag) FILTER (place) AS f, max(diag) FILTER (place) AS l,
             array_to_string(list_sort(list_distinct(list(label) FILTER (place))), ',') AS bl,
             array_to_string(list_sort(list_distinct(list(label) FILTER (cover >= {licenses.COVER}))), ',') AS la,
             max(cover) FILTER (cover >= {licenses.COVER}) AS s FROM c GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(f AS BIGINT) AS first_word,
       CAST(l AS BIGINT) AS last_word, coalesce(bl, '') AS base_labels, coalesce(la, '') AS labels, coalesce(s, 0.0::DOUBLE) AS score
FROM d LEFT JOIN a USING (doc_id)"""


_OP11 = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
           FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
FROM t WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id NULLS LAST)"""

#: DuckDB SQL of the queries that SQL can express (same column names).  The
#: others are tested against brute force (tests/llm): learned models (1, 3, 8, 10),
#: tokens (4, 13), eigenvectors (12), and the line join (5), which is too slow in SQL on whole tables.
ORACLE_SQL: dict[str, str] = {
    "op2_minhash_near_dedup": _OP2, "op6_license_scan": _op6_sql(), "op7_exact_top_k": _OP7, "op9_decontamination": _OP9,
    "op11_exact_dedup": _OP11}
