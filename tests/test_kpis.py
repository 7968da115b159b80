"""KPI and rollup semantics on hand-made rows."""

import datetime as dt

import pytest

from probity.functions.bands import ai_usage_bucket
from probity.operators import kpis, rollups
from probity.operators.archive import eligible
from probity.functions.timecols import recent

SCHEMA = ("attempt_id string, student_id string, exam_id string, question_id string, "
          "response_time double, is_correct boolean, ai_usage_score double, answer_hash string, "
          "submission_timestamp timestamp_ntz")
T0 = dt.datetime(2024, 1, 10, 12, 0, 0)


def att(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_one_attempt_pair_stddev(spark):
    a = att(spark, [("a", "S", "E", "Q", 10.0, True, 0.5, "h", T0)])
    samp = kpis.kpi_response_variance(a).first().response_variance
    pop = rollups.aggregated_kpis(a).first().response_variance
    assert samp is None and pop == 0.0          # quirk Q1


def test_null_is_correct_counts_as_wrong(spark):
    a = att(spark, [("a", "S", "E", "Q", 1.0, True, 0.1, "h", T0), ("b", "S", "E", "Q", 1.0, None, 0.1, "h", T0)])
    assert kpis.kpi_accuracy_rate(a).first().accuracy_rate == 50.0


def test_suspicion_max_variance_zero_becomes_100(spark):
    a = att(spark, [("a", "S", "E", "Q", 5.0, True, 0.5, "h", T0), ("b", "S", "E", "Q", 5.0, True, 0.5, "h", T0)])
    sessions = spark.createDataFrame([("S", "E", 0, 0, 0.0)],
                                     "student_id string, exam_id string, tab_switches int, "
                                     "focus_loss_count int, idle_time_seconds double")
    s = kpis.kpi_suspicion(a, sessions).first().suspicion_score
    assert s == pytest.approx(0.5 * 0.4 + (1 - 0 / 100) * 0.3)   # quirk Q3


def test_ai_usage_bucket_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.3,), (0.7,), (0.9999,), (1.0,), (None,)], "x double")
    got = [r.b for r in df.select(ai_usage_bucket("x").alias("b")).collect()]
    assert got == ["low", "medium", "high", "high", "other", "other"]   # quirk Q9


def test_global_average_on_empty_input(spark):
    a = att(spark, [])
    assert rollups.avg_response_time_all(a).count() == 0
    assert rollups.avg_response_time_all(a, empty_as_zero=True).first().value == 0.0


def test_cutoff_boundaries(spark):
    as_of = dt.datetime(2024, 1, 10, 12, 0, 0)
    us = dt.timedelta(microseconds=1)
    c48 = as_of - dt.timedelta(hours=48)
    c2 = as_of - dt.timedelta(hours=2)
    rows = [(n, "S", "E", "Q", 1.0, True, 0.1, "h", ts) for n, ts in
            [("at48", c48), ("before48", c48 - us), ("after48", c48 + us),
             ("at2", c2), ("before2", c2 - us), ("after2", c2 + us)]]
    a = att(spark, rows)
    old = {r.attempt_id for r in eligible(a, "submission_timestamp", as_of).collect()}
    new = {r.attempt_id for r in recent(a, "submission_timestamp", as_of, "2 hours").collect()}
    assert old == {"before48"}
    assert new == {"at2", "after2"}


def test_top_k_ties_broken_by_key(spark):
    rows = [(f"a{i}", f"S{i}", "E", "Q", 1.0, True, 0.9, "h", T0) for i in (3, 1, 2)]
    out = rollups.high_risk_students_top(att(spark, rows), 2).collect()
    assert [r.student_id for r in out] == ["S1", "S2"]


def test_missing_variance_is_most_suspicious(spark):
    # one-attempt pair: sample stddev NULL -> filled with 0 -> normalised 1 (quirk Q2)
    a = att(spark, [("a", "S1", "E", "Q", 5.0, True, 0.0, "h", T0),
                    ("b", "S2", "E", "Q", 5.0, True, 0.0, "h", T0),
                    ("c", "S2", "E", "Q", 25.0, True, 0.0, "h", T0)])
    sessions = spark.createDataFrame([], "student_id string, exam_id string, tab_switches int, "
                                         "focus_loss_count int, idle_time_seconds double")
    s = {r.student_id: r.suspicion_score for r in kpis.kpi_suspicion(a, sessions).collect()}
    assert s["S1"] == pytest.approx(0.3) and s["S2"] == pytest.approx(0.0)
