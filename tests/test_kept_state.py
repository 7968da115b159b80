"""R8 and R11 as kept state against the batch operators, over shuffled micro-batches."""

import datetime as dt
import random

from pyspark.sql import functions as F

from probity.operators import collusion, rollups
from probity.session import work_dir
from probity.streaming import windows as W

SCHEMA = ("attempt_id string, student_id string, exam_id string, question_id string, answer_hash string, response_time double, "
          "is_correct boolean, ai_usage_score double, submission_timestamp timestamp_ntz")


def batches(seed, n=8, per=40):
    """Rows over five hours, dealt to batches in shuffled time order; some values missing."""
    rng = random.Random(seed)
    t0 = dt.datetime(2024, 3, 1, 8)
    rows = [(f"a{i}", f"S{rng.randrange(6)}", f"E{rng.randrange(2)}", f"Q{rng.randrange(5)}", f"h{rng.randrange(2)}",
             rng.choice([None, 12.25, 100.0, 333.3333, round(rng.uniform(1, 500), 2)]), rng.choice([True, False, None]),
             rng.choice([None, 0.3, 0.71, 0.95]), t0 + dt.timedelta(seconds=rng.randrange(5 * 3600), microseconds=rng.randrange(10 ** 6)))
            for i in range(n * per)]
    rows.sort(key=lambda r: r[-1])
    parts = [rows[k * per:(k + 1) * per] for k in range(n)]
    order = [1, 0, 3, 2, 4, 6, 5, 7]
    mixed = [parts[k] for k in order]
    mixed[4].append(mixed[0].pop())                    # rows that come four batches late
    mixed[7].append(mixed[5].pop())
    return mixed


def micros(t):
    return (t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)


def rounded(df):
    return sorted(tuple(round(x, 6) if isinstance(x, float) else tuple(x) if isinstance(x, list) else x for x in r)
                  for r in df.collect())


def feed(spark, state, check, at, replay=3):
    seen, as_of = [], None
    for b, part in enumerate(batches(11)):
        df = spark.createDataFrame(part, SCHEMA).coalesce(2)
        state.add(df, b, None if as_of is None else micros(as_of))
        if b == replay:                                # the same batch once more, after a restart
            state.add(df, b, None)
        seen += part
        as_of = max(r[-1] for r in seen)
        if b in at:
            check(spark.createDataFrame(seen, SCHEMA), as_of, micros(as_of))


def test_rolling_kpis_equal_the_batch_rollup_after_each_batch(spark):
    state = W.RollingKpis(spark, work_dir(spark, "rolling"), "2 hours", "7 minutes")
    state.sums.runs.fan = state.log.runs.fan = 3
    counts = []

    def check(every, as_of, at):
        want = rollups.aggregated_kpis(every, as_of, "2 hours")
        got = state.current(at).select(*want.columns)
        assert rounded(got) == rounded(want)
        counts.append(state.log.rows().count())

    feed(spark, state, check, range(8))
    assert max(counts) < 8 * 40 and len(state.log.runs.all()) <= 6       # panes that were left are gone


def test_kept_collusion_equals_the_batch_pairs(spark):
    state = W.CollusionState(spark, work_dir(spark, "pairs"), "2 hours", "11 minutes")
    state.sums.runs.fan = state.log.runs.fan = 3

    def check(every, as_of, at):
        want = collusion.collusion_pairs(every, as_of, "2 hours").withColumn("detected_at", F.lit(as_of))
        got = state.current(at).withColumn("detected_at", F.lit(as_of)).select(*want.columns)
        assert rounded(got) == rounded(want) and want.count() > 3

    feed(spark, state, check, (0, 3, 5, 7))
