"""Work-folder rules: the session's spark.checkpoint.dir is used; a cluster
without one is refused instead of falling back to a machine-local folder."""

import pytest

from probity import session


def test_work_dir_lives_under_checkpoint_dir(spark):
    base = session.checkpoint_dir(spark)
    assert base == spark.conf.get("spark.checkpoint.dir")
    a, b = session.work_dir(spark, "x"), session.work_dir(spark, "x")
    assert a.startswith(base.rstrip("/") + "/probity-work/x-") and a != b


def test_materialize_round_trip(spark):
    df = spark.range(10).withColumnRenamed("id", "v")
    m = session.materialize(df, "roundtrip")
    assert sorted(r.v for r in m.collect()) == list(range(10))
    assert "probity-work/roundtrip-" in m.inputFiles()[0]


class _FakeSc:
    master = "yarn"

    def getCheckpointDir(self):
        return None


class _FakeConf:
    def get(self, key, default=None):
        return default


class _FakeSpark:
    sparkContext = _FakeSc()
    conf = _FakeConf()


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError):
        session.checkpoint_dir(_FakeSpark())


def test_a_scope_deletes_what_its_queries_wrote(spark):
    import os
    from conftest import SF_SMALL
    import __spark_entry__ as entry
    with session.work_scope(spark) as outer:
        kept = session.materialize(spark.range(3), "kept")
        with session.work_scope(spark) as inner:
            for name in ("collusion_pairs", "stream_tumbling_5m", "constraint_report"):
                entry.queries()[name](spark, SF_SMALL).write.format("noop").mode("overwrite").save()
            assert len(inner) > 6 and sum(map(os.path.isdir, inner)) > 4
        assert not any(os.path.exists(p) for p in inner)
        assert kept.count() == 3 and len(outer) == 1
    assert not os.path.exists(outer[0])
