"""Registered queries: text normalisation and hashing (T1-T5) over whole
documents, plus the T8-style checks on the answer texts they feed."""

from pyspark.sql import functions as F

from probity.functions import text
from probity.plans.catalog import register
from probity.plans.sql_text import chunks_sql, normalize_sql, words_sql


@register("normalize_text", sql=f"""
SELECT doc_id, {normalize_sql("text")} AS normalized FROM documents""")
def q_t1(t):
    d = t.raw("documents")
    return d.select("doc_id", text.normalize_text("text").alias("normalized"))


@register("answer_hash", sql=f"""
SELECT doc_id, sha256({normalize_sql("text")}) AS sha256, md5({normalize_sql("text")}) AS md5
FROM documents""")
def q_t2(t):
    d = t.raw("documents")
    return d.select("doc_id", text.answer_hash("text", "sha256").alias("sha256"),
                    text.answer_hash("text", "md5").alias("md5"))


@register("fuzzy_hash", sql=f"""
SELECT doc_id, array_to_string({chunks_sql(words_sql("text"))}, '-') AS fuzzy_hash
FROM documents""")
def q_t3(t):
    d = t.raw("documents")
    return d.select("doc_id", text.fuzzy_hash("text").alias("fuzzy_hash"))


@register("structural_hash", sql=f"""
SELECT doc_id, substr(md5(CAST(length(n) AS VARCHAR) || '-' || CAST(len(w) AS VARCHAR) || '-'
       || CAST(length(regexp_replace(n, '[^\\p{{Nd}}]', '', 'g')) AS VARCHAR)), 1, 16) AS structural_hash
FROM (SELECT doc_id, {normalize_sql("text")} AS n, {words_sql("text")} AS w FROM documents) d""")
def q_t5(t):
    d = t.raw("documents")
    return d.select("doc_id", text.structural_hash("text").alias("structural_hash"))


@register("jaccard_fuzzy", doubles=("jaccard",), sql=f"""
, h AS (
  SELECT doc_id, array_to_string({chunks_sql(words_sql("text"))}, '-') AS fuzzy_hash FROM documents
), pairs AS (
  SELECT a.doc_id AS doc_a, b.doc_id AS doc_b, a.fuzzy_hash AS ha, b.fuzzy_hash AS hb
  FROM h a JOIN h b ON b.doc_id = a.doc_id + 1
)
SELECT doc_a, doc_b,
       len(list_intersect(string_split(ha, '-'), string_split(hb, '-')))
       / len(list_distinct(list_concat(string_split(ha, '-'), string_split(hb, '-')))) AS jaccard
FROM pairs""")
def q_t4(t):
    """T4 between each document and the next one by id (an equi-join on
    ``doc_id + 1``, linear in the table)."""
    d = t.raw("documents").select("doc_id", text.fuzzy_hash("text").alias("h"))
    a = d.select(F.col("doc_id").alias("doc_a"), F.col("h").alias("ha"))
    b = d.select((F.col("doc_id") - 1).alias("doc_a"), F.col("doc_id").alias("doc_b"),
                 F.col("h").alias("hb"))
    return a.join(b, "doc_a").select("doc_a", "doc_b", text.jaccard_fuzzy("ha", "hb").alias("jaccard"))
