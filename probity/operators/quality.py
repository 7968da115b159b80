"""V1-V14 data-quality operators, J8 anti-join and J9 foreign-key violations.

Rules are data: a ``Rule`` names its table and carries the violation
predicate both as a Spark Column and as SQL text (the SQL form feeds the
DuckDB oracle).  ``constraint_report`` scans each table once, evaluates *all* its
row rules in one aggregate, and all key rules of all tables in two shuffles.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probity import schemas
from probity.functions.exact import mean
from probity.session import materialize

# The validator enumerations.
ENUMS = {
    ("students", "program"): ["Computer Science", "Data Science", "Software Engineering",
                              "Information Systems", "Business Analytics"],
    ("students", "region"): ["North America", "Europe", "Asia", "South America", "Africa",
                             "Oceania"],
    ("courses", "department"): ["Computer Science", "Mathematics", "Engineering", "Business",
                                "Statistics"],
    ("exams", "exam_type"): ["midterm", "final", "quiz", "assignment"],
    ("questions", "question_type"): ["MCQ", "short-answer", "essay", "coding", "true-false"],
    ("session_logs", "device_type"): ["Desktop", "Laptop", "Tablet", "Mobile"],
    ("session_logs", "browser"): ["Chrome", "Firefox", "Safari", "Edge", "Opera"],
}

# Required fields per table.
REQUIRED = {
    "students": ["student_id", "name", "email", "program", "academic_year", "region",
                 "skill_level"],
    "courses": ["course_id", "course_name", "difficulty_level", "department"],
    "exams": ["exam_id", "course_id", "exam_date", "duration_minutes", "total_marks",
              "exam_type"],
    "questions": ["question_id", "exam_id", "difficulty_level", "question_type", "max_marks"],
    "exam_attempts": ["attempt_id", "student_id", "exam_id", "question_id", "response_time",
                      "is_correct", "ai_usage_score", "answer_hash", "submission_timestamp"],
    "session_logs": ["log_id", "student_id", "exam_id", "session_start"],
}

# Inclusive ranges.
RANGES = {
    ("students", "academic_year"): (1, 5), ("students", "skill_level"): (0, 1),
    ("courses", "difficulty_level"): (1, 5), ("questions", "difficulty_level"): (1, 5),
    ("exam_attempts", "response_time"): (0, None), ("exam_attempts", "ai_usage_score"): (0, 1),
}

# Keys and relations of the six tables.
PRIMARY_KEYS = {"students": "student_id", "courses": "course_id", "exams": "exam_id",
                "questions": "question_id", "exam_attempts": "attempt_id",
                "session_logs": "log_id"}
UNIQUE_KEYS = [(t, k) for t, k in PRIMARY_KEYS.items()] + [("students", "email")]

# (child table, column, parent table, parent key)
FOREIGN_KEYS = [("exams", "course_id", "courses", "course_id"),
                ("questions", "exam_id", "exams", "exam_id"),
                ("exam_attempts", "student_id", "students", "student_id"),
                ("exam_attempts", "exam_id", "exams", "exam_id"),
                ("exam_attempts", "question_id", "questions", "question_id"),
                ("session_logs", "student_id", "students", "student_id"),
                ("session_logs", "exam_id", "exams", "exam_id")]

EMAIL_RE = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


@dataclass
class Rule:
    table: str
    name: str
    make: object           # () -> Column, true where the row breaks the rule
    sql: str               # the same predicate in SQL

    @property
    def violation(self) -> Column:
        return self.make()


def _q(v):
    return "'" + str(v).replace("'", "''") + "'"


def row_rules() -> list[Rule]:
    """V2 required, V3 enum, V4 range and V7 single-row cross-field rules."""
    rules: list[Rule] = []
    for t, cols in REQUIRED.items():
        for c in cols:
            rules.append(Rule(t, f"required:{c}", lambda c=c: F.col(c).isNull(), f"{c} IS NULL"))
    for (t, c), vals in ENUMS.items():
        rules.append(Rule(t, f"enum:{c}", lambda c=c, vals=vals: ~F.col(c).isin(vals),
                          f"{c} NOT IN ({', '.join(_q(v) for v in vals)})"))
    for (t, c), (lo, hi) in RANGES.items():
        s = f"{c} < {lo}" if hi is None else f"({c} < {lo} OR {c} > {hi})"
        rules.append(Rule(t, f"range:{c}", lambda c=c, lo=lo, hi=hi: (
            F.col(c) < lo if hi is None else (F.col(c) < lo) | (F.col(c) > hi)), s))
    cross = [
        ("students", "email_format", lambda: ~F.col("email").rlike(EMAIL_RE),
         f"NOT regexp_matches(email, '{EMAIL_RE}')"),
        ("courses", "credits_positive", lambda: F.col("credits") <= 0, "credits <= 0"),
        ("exams", "duration_positive", lambda: F.col("duration_minutes") <= 0,
         "duration_minutes <= 0"),
        ("exams", "total_marks_positive", lambda: F.col("total_marks") <= 0, "total_marks <= 0"),
        ("questions", "max_marks_positive", lambda: F.col("max_marks") <= 0, "max_marks <= 0"),
        ("questions", "question_number_positive", lambda: F.col("question_number") <= 0,
         "question_number <= 0"),
        ("questions", "expected_time_positive", lambda: F.col("expected_time_seconds") <= 0,
         "expected_time_seconds <= 0"),
        ("exam_attempts", "hash_length_64", lambda: F.length("answer_hash") != 64,
         "length(answer_hash) <> 64"),
        ("session_logs", "end_after_start",
         lambda: F.col("session_end") <= F.col("session_start"), "session_end <= session_start"),
    ]
    for c in ["keystroke_count", "paste_count", "marks_obtained"]:
        cross.append(("exam_attempts", f"non_negative:{c}", lambda c=c: F.col(c) < 0, f"{c} < 0"))
    for c in ["tab_switches", "focus_loss_count", "copy_count", "screenshot_attempts",
              "warnings_issued", "idle_time_seconds"]:
        cross.append(("session_logs", f"non_negative:{c}", lambda c=c: F.col(c) < 0, f"{c} < 0"))
    rules += [Rule(*r) for r in cross]
    return rules


def _rows(one_row: DataFrame, entries: list[tuple[str, str, str]]) -> DataFrame:
    """Turn a one-row aggregate into (table, rule, checked, violations) rows."""
    structs = [F.struct(F.lit(t).alias("table"), F.lit(r).alias("rule"),
                        F.col("_checked").alias("checked"), F.col(c).alias("violations"))
               for t, r, c in entries]
    return one_row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def table_rule_counts(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """All rules of one table in one aggregate."""
    mine = [r for r in rules if r.table == table]
    aggs = [F.count(F.lit(1)).alias("_checked")]
    aggs += [F.count(F.when(r.violation, 1)).alias(f"_v{i}") for i, r in enumerate(mine)]
    return _rows(df.agg(*aggs), [(table, r.name, f"_v{i}") for i, r in enumerate(mine)])


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose foreign key has no parent (non-null keys only)."""
    p = parent.select(F.col(key).alias(column)).distinct()
    return child.filter(F.col(column).isNotNull()).join(p, column, "left_anti")


def fk_orphan_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """J9 as rows: (relation, key) for every distinct orphan key of every relation.

    A child's keys are made distinct before the anti-join, so a hot key is one row there."""
    out = None
    for child, col, parent, key in FOREIGN_KEYS:
        o = (orphans(tables[child].select(col).distinct(), col, tables[parent], key)
             .select(F.lit(f"{child}.{col}->{parent}").alias("relation"),
                     F.col(col).cast("string").alias("key")))
        out = o if out is None else out.unionByName(o)
    return out


def _slim(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """What the report needs of a table, in one scan: the broken row rules as bits, the key columns and
    the columns of the marks rule."""
    mine = [r for r in rules if r.table == table]
    assert len(mine) < 63
    bits = F.lit(0).cast("long")
    for i, r in enumerate(mine):
        bits = bits.bitwiseOR(F.when(r.violation, F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    keys = {c for t, c in UNIQUE_KEYS if t == table} | {c for t, c, _, _ in FOREIGN_KEYS if t == table}
    keys |= {k for _, _, p, k in FOREIGN_KEYS if p == table}
    more = {"exam_attempts": ["marks_obtained"], "questions": ["max_marks"]}.get(table, [])
    return df.select(bits.alias("_broken"), *sorted(keys), *more)


def _tagged(slim: DataFrame, parts: list) -> DataFrame:
    """One row per row and part: (tag, key, marks), in one pass over ``slim``."""
    rows = [F.struct(F.lit(tag).alias("tag"), F.col(c).cast("string").alias("key"), m.cast("double").alias("marks")) for tag, c, m in parts]
    return slim.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def key_report(slim: dict[str, DataFrame]) -> DataFrame:
    """V5, V7 (marks) and V6 of all tables: (table, rule, checked, violations).

    The seven foreign keys are unpivoted to (relation, key, marks) with counts, in one
    shuffle that combines before it; one join meets the tagged keys of the parents, so a hot
    key is a few rows.  The unique keys of all tables are counted in one shuffle alike.
    """
    none = F.lit(None)
    marks = lambda child, parent: (child, parent) == ("exam_attempts", "questions")
    children, parents, unique = [], [], []
    for t in slim:
        refs = [(i, c, F.col("marks_obtained") if marks(t, p) else none) for i, (child, c, p, _) in enumerate(FOREIGN_KEYS) if child == t]
        if refs:
            children.append(_tagged(slim[t], refs))
        heads = [(i, k, F.col("max_marks") if marks(child, t) else none) for i, (child, _, p, k) in enumerate(FOREIGN_KEYS) if p == t]
        if heads:
            parents.append(_tagged(slim[t], heads))
        unique.append(_tagged(slim[t], [(i, k, none) for i, (u, k) in enumerate(UNIQUE_KEYS) if u == t]))
    keys = _union(children).groupBy("tag", "key", "marks").agg(F.count(F.lit(1)).alias("n"))
    held = _union(parents).filter("key is not null").groupBy("tag", "key").agg(F.max("marks").alias("most"), F.lit(True).alias("hit"))
    bad = F.sum(F.when(F.col("key").isNotNull() & F.col("hit").isNull(), F.col("n")).otherwise(0))
    over = F.sum(F.when(F.col("marks") > F.col("most"), F.col("n")).otherwise(0))
    checked = F.sum("n").alias("checked")
    refs = keys.join(held, ["tag", "key"], "left").groupBy("tag").agg(checked, bad.alias("bad"), over.alias("over"))
    name = lambda i, rule: F.struct(F.lit(FOREIGN_KEYS[i][0]).alias("table"), F.lit(rule).alias("rule"))
    names = [F.struct(F.lit(c).alias("table"), F.lit(f"fk:{col}->{p}").alias("rule")) for c, col, p, _ in FOREIGN_KEYS]
    asked = held.sparkSession.range(len(FOREIGN_KEYS)).select(F.col("id").cast("int").alias("tag"))
    refs = asked.join(refs, "tag", "left").fillna(0)       # a table without rows is checked as well
    at = next(i for i, (c, _, p, _) in enumerate(FOREIGN_KEYS) if marks(c, p))
    rows = refs.select(F.explode(F.array(
        F.struct(F.element_at(F.array(*names), F.col("tag") + 1).alias("of"), "checked", F.col("bad").alias("violations")),
        F.struct(F.when(F.col("tag") == at, name(at, "marks_le_max")).alias("of"), "checked", F.col("over").alias("violations")))).alias("r"))
    rows = rows.select("r.of.*", "r.checked", "r.violations").filter("table is not null")
    twice = _union(unique).groupBy("tag", "key").agg(F.count(F.lit(1)).alias("n")).groupBy("tag").agg(
        checked, F.count(F.when(F.col("n") > 1, 1)).alias("violations"))
    asked = held.sparkSession.range(len(UNIQUE_KEYS)).select(F.col("id").cast("int").alias("tag"))
    names = [F.struct(F.lit(t).alias("table"), F.lit(f"unique:{k}").alias("rule")) for t, k in UNIQUE_KEYS]
    twice = asked.join(twice, "tag", "left").fillna(0).select(
        F.element_at(F.array(*names), F.col("tag") + 1).alias("of"), "checked", "violations").select("of.*", "checked", "violations")
    return rows.unionByName(twice)


def constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    """V8: one row per rule: table, rule, checked, violations, passed.

    Every table is scanned once, for its slim form (``_slim``), which is written; the row
    rules are one aggregate a table over it, all keys one report (``key_report``)."""
    rules = row_rules()
    with ThreadPoolExecutor(len(REQUIRED)) as pool:        # the six writes do not wait for each other
        slim = dict(zip(REQUIRED, pool.map(lambda t: materialize(_slim(tables[t], t, rules), f"slim-{t}"), REQUIRED)))
    parts = []
    for t, df in slim.items():
        mine = [r for r in rules if r.table == t]
        bit = lambda i: F.col("_broken").bitwiseAND(F.lit(1 << i).cast("long")) != 0
        one = df.agg(F.count(F.lit(1)).alias("_checked"), *[F.count(F.when(bit(i), 1)).alias(f"_v{i}") for i in range(len(mine))])
        parts.append(_rows(one, [(t, r.name, f"_v{i}") for i, r in enumerate(mine)]))
    return _union([*parts, key_report(slim)]).withColumn("passed", F.col("violations") == 0)


def required_nulls(attempts: DataFrame, sessions: DataFrame) -> DataFrame:
    """V1: null counts in the fields checked by the validation job."""
    a = attempts.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c)
                       for c in ["student_id", "exam_id", "ai_usage_score"]])
    s = sessions.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c)
                       for c in ["student_id", "exam_id"]])
    ra = a.select(F.explode(F.array(*[F.struct(F.lit("exam_attempts").alias("table"),
                                               F.lit(c).alias("field"), F.col(c).alias("nulls"))
                                      for c in a.columns])).alias("r")).select("r.*")
    rs = s.select(F.explode(F.array(*[F.struct(F.lit("session_logs").alias("table"),
                                               F.lit(c).alias("field"), F.col(c).alias("nulls"))
                                      for c in s.columns])).alias("r")).select("r.*")
    return ra.unionByName(rs)


def quarantine_split(df: DataFrame, table: str) -> DataFrame:
    """V9: every row with ``valid`` and its list of broken rules (in rule order)."""
    rules = [r for r in row_rules() if r.table == table]
    reasons = F.filter(F.array(*[F.when(r.violation, F.lit(r.name)) for r in rules]),
                       lambda x: x.isNotNull())
    return df.withColumn("reasons", reasons).withColumn("valid", F.size("reasons") == 0)


def quarantine(tables: dict[str, DataFrame]) -> DataFrame:
    """V9 of all tables: (table, key, reasons, valid), one row per row of each table."""
    return _union([quarantine_split(tables[n], n).select(F.lit(n).alias("table"), F.col(k).cast("string").alias("key"), "reasons", "valid")
                   for n, k in PRIMARY_KEYS.items()])


def record_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    out = None
    for t, df in tables.items():
        r = df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(t).alias("table"), "records")
        out = r if out is None else out.unionByName(r)
    return out


_WIDTH = {"int": 4, "bigint": 8, "double": 8, "boolean": 1, "timestamp": 8, "timestamp_ntz": 8}


def estimated_row_bytes(table: str) -> Column:
    """Estimated stored bytes of one row: string bytes + fixed widths."""
    total = F.lit(0).cast("long")
    for f in schemas.TABLE_SCHEMAS[table].fields:
        t = f.dataType.simpleString()
        if t == "string":
            total = total + F.coalesce(F.octet_length(f.name), F.lit(0))
        else:
            total = total + F.lit(_WIDTH.get(t, 8))
    return total


def estimated_row_bytes_sql(table: str) -> str:
    parts = []
    for f in schemas.TABLE_SCHEMAS[table].fields:
        t = f.dataType.simpleString()
        parts.append(f"coalesce(strlen({f.name}), 0)" if t == "string" else str(_WIDTH.get(t, 8)))
    return " + ".join(parts)


def volume_alert(tables: dict[str, DataFrame], min_mb: float = 300, max_mb: float = 600,
                 gate_mb: float = 250, archive_mb: float = 500) -> DataFrame:
    """Estimated hot-data size with the monitor's alert levels, the
    validation gate and the archival trigger (thresholds are parameters)."""
    out = None
    for t, df in tables.items():
        r = df.agg(F.sum(estimated_row_bytes(t)).alias("b")).select(
            F.coalesce("b", F.lit(0)).alias("b"))
        out = r if out is None else out.unionByName(r)
    mb = F.col("bytes") / (1024 * 1024)
    return (out.agg(F.sum("b").cast("long").alias("bytes"))
            .select("bytes", mb.alias("size_mb"),
                    F.when(mb < min_mb, "WARNING").when(mb > max_mb, "CRITICAL").otherwise("OK")
                    .alias("level"),
                    (mb >= gate_mb).alias("validation_pass"),
                    (mb > archive_mb).alias("archive_trigger")))


def outlier_flags(df: DataFrame, column: str = "response_time", key: str = "attempt_id",
                  k: float = 3.0) -> DataFrame:
    """Rows more than ``k`` population standard deviations from the mean.

    Mean and deviation are scalar subqueries (one small job each), not a join.
    """
    stats = df.agg(mean(column).alias("m"), F.stddev_pop(column).alias("s"))
    m = stats.select("m").scalar()
    s = stats.select("s").scalar()
    return (df.select(key, column, ((F.col(column) - m) / s).alias("z_score"))
            .filter(F.abs(F.col(column) - m) > F.lit(k) * s))


def missing_rate(df: DataFrame) -> DataFrame:
    """Share of nulls per column."""
    aggs = [mean(F.col(c).isNull().cast("int")).alias(c) for c in df.columns]
    one = df.agg(*aggs)
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                                   F.col(c).alias("missing_rate"))
                                          for c in df.columns])).alias("r")).select("r.*")


def distribution_summary(df: DataFrame, column: str = "response_time",
                         by: list[str] | None = None) -> DataFrame:
    """Mean, population stddev, min, max (and count) of ``column``."""
    aggs = [mean(column).alias("mean"), F.stddev_pop(column).alias("std"),
            F.min(column).alias("min"), F.max(column).alias("max"),
            F.count(column).alias("count")]
    return df.groupBy(*(by or [])).agg(*aggs)


def anti_join_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``keys``."""
    return df.join(keys.select(*on).distinct(), on, "left_anti")
