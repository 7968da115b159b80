"""Declared schemas for the six exam tables and the two message topics.

Reads never infer a schema: batch sources are read with these StructTypes
(or projected onto them by the adapters) and streams decode JSON with them.
"""

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
TS, TSNTZ = T.TimestampType(), T.TimestampNTZType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


STUDENTS = _struct(("student_id", S), ("name", S), ("email", S), ("program", S),
                   ("academic_year", I), ("region", S), ("skill_level", D),
                   ("enrollment_date", TSNTZ))

COURSES = _struct(("course_id", S), ("course_name", S), ("instructor_id", S),
                  ("instructor_name", S), ("difficulty_level", I), ("department", S),
                  ("credits", I))

EXAMS = _struct(("exam_id", S), ("course_id", S), ("exam_name", S), ("exam_date", TSNTZ),
                ("duration_minutes", I), ("total_marks", I), ("exam_type", S),
                ("proctored", B))

QUESTIONS = _struct(("question_id", S), ("exam_id", S), ("question_number", I),
                    ("difficulty_level", I), ("question_type", S), ("max_marks", I),
                    ("expected_time_seconds", I), ("topic", S))

EXAM_ATTEMPTS = _struct(("attempt_id", S), ("student_id", S), ("exam_id", S),
                        ("question_id", S), ("response_time", D), ("is_correct", B),
                        ("ai_usage_score", D), ("keystroke_count", I), ("paste_count", I),
                        ("answer_hash", S), ("answer_text", S),
                        ("submission_timestamp", TSNTZ), ("marks_obtained", I),
                        ("flagged", B))

SESSION_LOGS = _struct(("log_id", S), ("student_id", S), ("exam_id", S), ("tab_switches", I),
                       ("idle_time_seconds", D), ("focus_loss_count", I), ("copy_count", I),
                       ("screenshot_attempts", I), ("device_type", S), ("browser", S),
                       ("ip_address", S), ("session_start", TSNTZ), ("session_end", TSNTZ),
                       ("warnings_issued", I))

# Messages on the two topics carry timestamps as ISO-8601 strings; the reduced
# message form lacks some fields, which then decode to null.
ATTEMPT_MESSAGE = _struct(("attempt_id", S), ("student_id", S), ("exam_id", S),
                          ("question_id", S), ("response_time", D), ("is_correct", B),
                          ("ai_usage_score", D), ("keystroke_count", I), ("paste_count", I),
                          ("answer_hash", S), ("answer_text", S),
                          ("submission_timestamp", S), ("marks_obtained", I),
                          ("flagged", B))

SESSION_MESSAGE = _struct(("log_id", S), ("student_id", S), ("exam_id", S),
                          ("tab_switches", I), ("idle_time_seconds", D),
                          ("focus_loss_count", I), ("copy_count", I),
                          ("screenshot_attempts", I), ("device_type", S), ("browser", S),
                          ("ip_address", S), ("session_start", S), ("session_end", S),
                          ("warnings_issued", I))

TABLE_SCHEMAS = {
    "students": STUDENTS, "courses": COURSES, "exams": EXAMS, "questions": QUESTIONS,
    "exam_attempts": EXAM_ATTEMPTS, "session_logs": SESSION_LOGS,
}

# Driver tables (read with these schemas so a scan never infers).
EVENTS = _struct(("event_id", L), ("ts", TSNTZ), ("user_id", L), ("event_type", S),
                 ("value", D), ("props", S))
CUSTOMER = _struct(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D),
                   ("c_mktsegment", S))
NATION = _struct(("n_nationkey", I), ("n_name", S), ("n_regionkey", I))
REGION = _struct(("r_regionkey", I), ("r_name", S))
DOCUMENTS = _struct(("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L))

SOURCE_SCHEMAS = {"events": EVENTS, "customer": CUSTOMER, "nation": NATION,
                  "region": REGION, "documents": DOCUMENTS}
