"""DuckDB SQL for the same exam-table adapters as ``probity.sources.tables``.

The oracle queries are written independently in SQL over the driver's raw
tables; this prefix defines the exam tables as CTEs so each oracle query can
refer to ``exam_attempts``, ``session_logs``, ``students``, ``exams``,
``questions``, ``courses`` and ``answers``.
"""

ADAPTERS = r"""
ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
),
exam_attempts AS (
  SELECT 'ATT' || lpad(CAST(event_id AS VARCHAR), 9, '0') AS attempt_id,
         'STU' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS student_id,
         'EXM_' || event_type AS exam_id,
         'QST_' || event_type || '_' || CAST(k % 10 AS VARCHAR) AS question_id,
         value AS response_time,
         ((event_id * 31 + k) % 10) < 7 AS is_correct,
         (CASE WHEN user_id % 20 < 15 THEN 0.0::DOUBLE WHEN user_id % 20 < 18 THEN 0.75::DOUBLE
               ELSE 0.3::DOUBLE END)
         + (CASE WHEN user_id % 20 < 15 THEN 0.3::DOUBLE WHEN user_id % 20 < 18 THEN 0.23::DOUBLE
                 ELSE 0.3::DOUBLE END)
           * (CAST((event_id * 7919) % 1000 AS DOUBLE) / 1000.0::DOUBLE) AS ai_usage_score,
         CAST((event_id * 13) % 500 AS INTEGER) AS keystroke_count,
         CAST(k % 4 AS INTEGER) AS paste_count,
         sha256(event_type || ' ' || CAST(k AS VARCHAR)) AS answer_hash,
         event_type || ' ' || CAST(k AS VARCHAR) AS answer_text,
         ts AS submission_timestamp,
         CAST(CASE WHEN ((event_id * 31 + k) % 10) < 7 THEN 10 ELSE event_id % 10 END AS INTEGER)
           AS marks_obtained,
         (user_id % 20) BETWEEN 15 AND 17 AS flagged
  FROM ev
),
session_logs AS (
  SELECT 'LOG' || lpad(CAST(min(event_id) AS VARCHAR), 9, '0') AS log_id,
         'STU' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS student_id,
         'EXM_' || event_type AS exam_id,
         CAST(sum(k % 7) AS INTEGER) AS tab_switches,
         CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS idle_time_seconds,
         CAST(sum(k % 5) AS INTEGER) AS focus_loss_count,
         CAST(sum(k % 3) AS INTEGER) AS copy_count,
         CAST(count(CASE WHEN k = 0 THEN 1 END) AS INTEGER) AS screenshot_attempts,
         (['Desktop', 'Laptop', 'Tablet', 'Mobile'])[user_id % 4 + 1] AS device_type,
         (['Chrome', 'Firefox', 'Safari', 'Edge', 'Opera'])[user_id % 5 + 1] AS browser,
         '10.0.' || CAST(CAST(floor(user_id / 250) AS BIGINT) AS VARCHAR) || '.'
           || CAST(user_id % 250 AS VARCHAR) AS ip_address,
         min(ts) AS session_start,
         max(ts) AS session_end,
         CAST(max(k) % 3 AS INTEGER) AS warnings_issued
  FROM ev
  GROUP BY user_id, event_type, date_trunc('week', ts)
),
students AS (
  SELECT 'STU' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS student_id,
         c_name AS name,
         lower(replace(c_name, '#', '.')) || '@university.edu' AS email,
         c_mktsegment AS program,
         CAST(c_custkey % 5 + 1 AS INTEGER) AS academic_year,
         r_name AS region,
         round((c_acctbal + 1000) / 11000, 2) AS skill_level,
         TIMESTAMP '2020-01-01 00:00:00' + to_days(CAST(c_custkey % 1461 AS INTEGER)) AS enrollment_date
  FROM customer
  LEFT JOIN (SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) g
    ON c_nationkey = g.n_nationkey
),
exams AS (
  SELECT 'EXM_' || event_type AS exam_id,
         'CRS_' || event_type AS course_id,
         event_type || ' exam' AS exam_name,
         TIMESTAMP '2024-01-01 00:00:00' AS exam_date,
         120 AS duration_minutes,
         100 AS total_marks,
         CASE event_type WHEN 'click' THEN 'midterm' WHEN 'error' THEN 'midterm'
              WHEN 'view' THEN 'final' WHEN 'purchase' THEN 'quiz'
              WHEN 'signup' THEN 'assignment' END AS exam_type,
         event_type <> 'error' AS proctored
  FROM (SELECT DISTINCT event_type FROM events) d
),
courses AS (
  SELECT 'CRS_' || event_type AS course_id,
         event_type || ' course' AS course_name,
         'INS_' || event_type AS instructor_id,
         'Instructor ' || event_type AS instructor_name,
         CAST(CASE event_type WHEN 'click' THEN 2 WHEN 'error' THEN 4 WHEN 'purchase' THEN 3
              WHEN 'signup' THEN 1 WHEN 'view' THEN 5 END AS INTEGER) AS difficulty_level,
         CASE event_type WHEN 'click' THEN 'Computer Science' WHEN 'error' THEN 'Engineering'
              WHEN 'purchase' THEN 'Business' WHEN 'signup' THEN 'Mathematics'
              WHEN 'view' THEN 'Physics' END AS department,
         3 AS credits
  FROM (SELECT DISTINCT event_type FROM events) d
),
questions AS (
  SELECT 'QST_' || event_type || '_' || CAST(q AS VARCHAR) AS question_id,
         'EXM_' || event_type AS exam_id,
         CAST(q + 1 AS INTEGER) AS question_number,
         CAST(q % 5 + 1 AS INTEGER) AS difficulty_level,
         (['MCQ', 'short-answer', 'essay', 'coding', 'true-false'])[q % 5 + 1] AS question_type,
         10 AS max_marks,
         90 AS expected_time_seconds,
         event_type AS topic
  FROM (SELECT DISTINCT event_type, k % 10 AS q FROM ev) d
),
answers AS (
  SELECT doc_id AS student_id, lang AS question_id, source AS exam_id, text AS answer_text
  FROM documents
),
as_of AS (
  SELECT max(ts) AS t FROM events
)
"""


def with_adapters(body: str) -> str:
    """Prefix ``body`` with the adapter CTEs.  ``body`` is either a SELECT or
    further CTEs written as ``, name AS (...) SELECT ...``."""
    return "WITH " + ADAPTERS + body
