import pytest
from pyspark import SparkContext

from shelflens.operators.keep import keep, released, spread


def test_kept_rows_have_no_plan_behind_them(spark, tmp_path):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path))
    kept = keep(spark.range(10).selectExpr("id * 2 AS x"))
    assert "Range" not in kept._jdf.queryExecution().toString()
    assert sorted(r.x for r in kept.collect()) == list(range(0, 20, 2))


@pytest.fixture
def no_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(SparkContext, "getCheckpointDir", lambda self: None)
    conf = type(spark.conf)
    real = conf.get

    def without(self, key, *default):
        return default[0] if key == "spark.checkpoint.dir" else real(self, key, *default)

    monkeypatch.setattr(conf, "get", without)


def test_a_scope_lets_go_what_was_cached_in_it(spark, no_shared_folder):
    before = keep(spark.range(5))
    with pytest.raises(ZeroDivisionError), released():
        inner = keep(spark.range(7))
        with released():
            innermost = keep(spark.range(9))
            assert innermost.storageLevel.useMemory
        assert inner.storageLevel.useMemory and not innermost.storageLevel.useMemory
        raise ZeroDivisionError
    assert before.storageLevel.useMemory and not inner.storageLevel.useMemory
    before.unpersist()


def test_a_cluster_without_a_shared_folder_draws_a_warning(spark, no_shared_folder, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    with pytest.warns(UserWarning, match="checkpoint"):
        keep(spark.range(3)).unpersist()


def test_without_a_shared_folder_rows_are_cached(spark, no_shared_folder):
    kept = keep(spark.range(10))
    assert kept.storageLevel.useMemory and kept.count() == 10
    kept.unpersist()


def test_spread_runs_nothing_and_never_shrinks_below_the_session(spark):
    few = spark.range(100, numPartitions=1)
    assert spread(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(few, 3).rdd.getNumPartitions() == 3
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert spread(few).rdd.getNumPartitions() == 64
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("spread", "spread")
    try:
        spread(few.join(spark.range(50), "id").groupBy("id").count())
        assert not tracker.getJobIdsForGroup("spread")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
