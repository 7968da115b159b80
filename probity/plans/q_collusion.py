"""Registered queries: answer-hash collusion and text similarity
(J1, J7, A5, Q7, A19, A20, A21, T6, T7)."""

from probity.functions.bands import similarity_band
from probity.functions.text import answer_hash
from probity.operators import collusion, similarity
from probity.plans.catalog import register
from probity.plans.sql_text import normalize_sql, tokens_sql

_MATCH_JOIN = """
FROM exam_attempts a1 JOIN exam_attempts a2
  ON a1.exam_id = a2.exam_id AND a1.question_id = a2.question_id
 AND a1.answer_hash = a2.answer_hash AND a1.student_id < a2.student_id"""


@register("hash_match_pairs", sql=f"""
SELECT a1.student_id AS student_1, a2.student_id AS student_2, a1.exam_id, a1.question_id,
       count(*) AS attempt_pairs {_MATCH_JOIN}
GROUP BY 1, 2, 3, 4""")
def q_j1(t):
    return collusion.hash_match_pairs(t.attempts)


@register("kpi_answer_similarity", sql=f"""
SELECT a1.student_id AS student_1, a2.student_id AS student_2, a1.exam_id,
       count(*) AS matching_questions
{_MATCH_JOIN}
GROUP BY 1, 2, 3""")
def q_a5(t):
    return collusion.kpi_answer_similarity(t.attempts)


_CLASSES = """
, mem AS (
  SELECT exam_id, student_id, question_id, answer_hash, count(*) AS n
  FROM exam_attempts WHERE exam_id IS NOT NULL AND student_id IS NOT NULL AND question_id IS NOT NULL AND answer_hash IS NOT NULL
  GROUP BY 1, 2, 3, 4
), sheet AS (
  SELECT exam_id, student_id, string_agg(question_id || '|' || answer_hash || '|' || n, ';' ORDER BY question_id, answer_hash) AS s
  FROM mem GROUP BY 1, 2
), cls AS (
  SELECT exam_id, student_id, min(student_id) OVER w AS class_id, count(*) OVER w AS class_size
  FROM sheet WINDOW w AS (PARTITION BY exam_id, s)
)"""


@register("answer_classes", sql=_CLASSES + "SELECT exam_id, student_id, class_id, class_size FROM cls")
def q_classes(t):
    return collusion.answer_classes(t.attempts)


@register("answer_class_pairs", sql=_CLASSES + """
, p AS (
  SELECT a.exam_id, x.class_id AS class_1, y.class_id AS class_2, a.student_id AS s1, b.student_id AS s2, sum(a.n * b.n) AS mq
  FROM mem a JOIN mem b ON a.exam_id = b.exam_id AND a.question_id = b.question_id AND a.answer_hash = b.answer_hash
    AND a.student_id < b.student_id
  JOIN cls x ON x.exam_id = a.exam_id AND x.student_id = a.student_id
  JOIN cls y ON y.exam_id = b.exam_id AND y.student_id = b.student_id
  GROUP BY ALL
)
SELECT exam_id, least(class_1, class_2) AS class_1, greatest(class_1, class_2) AS class_2,
       CAST(max(mq) AS BIGINT) AS matching_questions, count(*) AS links
FROM p GROUP BY 1, 2, 3""")
def q_class_pairs(t):
    """A5 with students of identical answers taken together; pairs on request (expand_class_pairs)."""
    return collusion.answer_class_pairs(t.attempts)[1]


@register("answer_jaccard", doubles=("answer_jaccard",), sql=f"""
, p AS (
  SELECT a1.student_id AS student_1, a2.student_id AS student_2, a1.exam_id,
         count(DISTINCT a1.question_id) AS mqd {_MATCH_JOIN}
  GROUP BY 1, 2, 3
), ans AS (
  SELECT student_id, exam_id, count(DISTINCT question_id) AS answered
  FROM exam_attempts GROUP BY 1, 2
)
SELECT p.student_1, p.student_2, p.exam_id, p.mqd AS matching_questions_distinct,
       p.mqd / (x.answered + y.answered - p.mqd) AS answer_jaccard
FROM p JOIN ans x ON x.student_id = p.student_1 AND x.exam_id = p.exam_id
       JOIN ans y ON y.student_id = p.student_2 AND y.exam_id = p.exam_id""")
def q_q7(t):
    return collusion.answer_jaccard(t.attempts)


_A20 = """
, m AS (
  SELECT least(l.student_id, r.student_id) AS student_1_id,
         greatest(l.student_id, r.student_id) AS student_2_id,
         l.exam_id, l.question_id,
         abs(epoch_us(l.submission_timestamp) - epoch_us(r.submission_timestamp)) AS us
  FROM exam_attempts l JOIN exam_attempts r
    ON l.exam_id = r.exam_id AND l.question_id = r.question_id
   AND l.answer_hash = r.answer_hash AND l.student_id <> r.student_id
  WHERE l.submission_timestamp >= (SELECT t FROM as_of) - INTERVAL 7 DAY {extra}
)
SELECT student_1_id, student_2_id, exam_id, count(*) AS matching_questions_count,
       mean(us) / 1e6 AS avg_time_difference_seconds,
       list_sort(list_distinct(list(question_id))) AS questions,
       count(*) / 50 AS similarity_score,
       CASE WHEN count(*) >= 10 THEN 'High' WHEN count(*) >= 5 THEN 'Medium' ELSE 'Low' END AS risk_level,
       (SELECT t FROM as_of) AS detected_at
FROM m GROUP BY 1, 2, 3 HAVING count(*) >= 3"""

_A20_DOUBLES = ("avg_time_difference_seconds", "similarity_score")


@register("collusion_pairs", doubles=_A20_DOUBLES, sql=_A20.format(extra=""))
def q_a20(t):
    return collusion.collusion_pairs(t.attempts, t.as_of, "7 days")


@register("collusion_pairs_once", doubles=_A20_DOUBLES, sql=_A20.format(
    extra="AND (r.submission_timestamp < (SELECT t FROM as_of) - INTERVAL 7 DAY"
          " OR l.student_id < r.student_id)"))
def q_a20_once(t):
    return collusion.collusion_pairs(t.attempts, t.as_of, "7 days", once=True)


_GROUPS = """
, m AS (
  SELECT {g}, student_id, count(*) AS n FROM {src} GROUP BY {g}, student_id
), s AS (
  SELECT {g}, count(*) AS group_size, min(student_id) AS representative
  FROM m GROUP BY {g} HAVING count(*) >= 2
)
SELECT {mg}, m.student_id, s.representative, s.group_size, m.n AS answers
FROM m JOIN s ON {on}"""


def _groups_sql(cols, src):
    return _GROUPS.format(g=", ".join(cols), src=src, mg=", ".join(f"m.{c}" for c in cols),
                          on=" AND ".join(f"m.{c} = s.{c}" for c in cols))


@register("hash_group_pairs", sql=_groups_sql(["question_id", "answer_hash"], "exam_attempts"))
def q_j7(t):
    return collusion.hash_groups(t.attempts.select("student_id", "question_id", "answer_hash"))


@register("exact_duplicate_answers", sql=f"""
, hashed AS (
  SELECT student_id, question_id, sha256({normalize_sql("answer_text")}) AS answer_hash
  FROM answers
)""" + _groups_sql(["question_id", "answer_hash"], "hashed"))
def q_t6(t):
    a = t.answers.select("student_id", "question_id",
                         answer_hash("answer_text").alias("answer_hash"))
    return collusion.hash_groups(a)


@register("pair_suspicion", doubles=("suspicion_score",), sql="""
SELECT a1.student_id AS student_1, a2.student_id AS student_2, count(*) AS matching_questions,
       list_sort(list_distinct(list(a1.question_id))) AS questions,
       least(count(*) / 5.0::DOUBLE, 1.0::DOUBLE) AS suspicion_score,
       CASE WHEN least(count(*) / 5.0::DOUBLE, 1.0::DOUBLE) >= 0.7 THEN 'High'
            WHEN least(count(*) / 5.0::DOUBLE, 1.0::DOUBLE) >= 0.4 THEN 'Medium' ELSE 'Low' END
         AS risk_level
FROM exam_attempts a1 JOIN exam_attempts a2
  ON a1.question_id = a2.question_id AND a1.answer_hash = a2.answer_hash
 AND a1.student_id < a2.student_id
GROUP BY 1, 2""")
def q_a21(t):
    return collusion.pair_suspicion(t.attempts.select("student_id", "question_id", "answer_hash"), 5)


@register("collusion_cases", sql="""
, r AS (
  SELECT * FROM exam_attempts
  WHERE submission_timestamp >= (SELECT t FROM as_of) - INTERVAL 7 DAY
), g AS (
  SELECT exam_id, question_id, answer_hash, count(*) AS count
  FROM r GROUP BY 1, 2, 3
  HAVING count(*) >= 2 AND count(DISTINCT student_id) >= 2
  ORDER BY count DESC, exam_id, question_id, answer_hash LIMIT 50
)
SELECT g.exam_id, g.question_id,
       list_slice(list_sort(list(DISTINCT r.student_id)), 1, 5) AS students, g.count
FROM g JOIN r ON g.exam_id = r.exam_id AND g.question_id = r.question_id
             AND g.answer_hash = r.answer_hash
GROUP BY g.exam_id, g.question_id, g.answer_hash, g.count""")
def q_a19(t):
    return collusion.collusion_cases(t.attempts, t.as_of, "7 days")


@register("near_duplicate_answers", doubles=("jaccard",), sql=f"""
, ch AS ({tokens_sql("doc_id", "text", "documents")}
), reps AS (
  SELECT min(id) AS id, any_value(toks) AS toks FROM ch GROUP BY array_to_string(toks, ',')
), tk AS (
  SELECT id, len(toks) AS n, unnest(toks) AS tok FROM reps
), inter AS (
  SELECT a.id AS doc_a, b.id AS doc_b, count(*) AS i, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM tk a JOIN tk b ON a.tok = b.tok AND a.id < b.id GROUP BY 1, 2
)
SELECT doc_a, doc_b, i / (na + nb - i) AS jaccard FROM inter WHERE i / (na + nb - i) >= 0.8""")
def q_t7(t):
    return similarity.near_duplicates(t.raw("documents"), "doc_id", "text", 0.8)


@register("near_duplicate_bands", doubles=("jaccard",), sql=f"""
, ch AS ({tokens_sql("doc_id", "text", "documents")}
), reps AS (
  SELECT min(id) AS id, any_value(toks) AS toks FROM ch GROUP BY array_to_string(toks, ',')
), tk AS (
  SELECT id, len(toks) AS n, unnest(toks) AS tok FROM reps
), inter AS (
  SELECT a.id AS doc_a, b.id AS doc_b, count(*) AS i, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM tk a JOIN tk b ON a.tok = b.tok AND a.id < b.id GROUP BY 1, 2
)
SELECT doc_a, doc_b, i / (na + nb - i) AS jaccard,
       CASE WHEN i / (na + nb - i) > 0.80 THEN 'strong' WHEN i / (na + nb - i) >= 0.60 THEN 'possible'
            ELSE 'coincidental' END AS similarity_band
FROM inter WHERE i / (na + nb - i) >= 0.6""")
def q_t7_bands(t):
    """T7 at the C8 'possible' threshold (0.6), with the C8 band."""
    nd = similarity.near_duplicates(t.raw("documents"), "doc_id", "text", 0.6)
    return nd.withColumn("similarity_band", similarity_band("jaccard"))


@register("copy_classes", sql=f"""
, ch AS ({tokens_sql("doc_id", "text", "documents")}
), c AS (
  SELECT array_to_string(toks, ',') AS sig, min(id) AS representative, count(*) AS copies
  FROM ch GROUP BY 1
)
SELECT ch.id, c.representative, c.copies FROM ch JOIN c ON array_to_string(ch.toks, ',') = c.sig""")
def q_t7_classes(t):
    return similarity.copy_classes(similarity.token_sets(t.raw("documents")))
