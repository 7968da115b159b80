"""The kept state of R11 holds rows, not matches."""

import datetime as dt

from probity.session import work_dir
from probity.streaming import windows as W


def test_collusion_state_grows_with_the_rows(spark):
    """200 students with one answer: 19,900 pairs, and as many sums were kept."""
    t0 = dt.datetime(2024, 1, 10, 12)
    df = spark.createDataFrame([(f"S{k:03d}", "E", f"Q{q}", "h", t0) for k in range(200) for q in range(3)],
                               "student_id string, exam_id string, question_id string, answer_hash string, submission_timestamp timestamp_ntz")
    state = W.CollusionState(spark, work_dir(spark, "linear"), "2 hours", "10 minutes")
    state.add(df, 0)
    assert state.sums.total().count() == 3 and state.log.rows().count() == 600
    at = (t0 - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    assert state.current(at).count() == 199 * 100
