"""The shared work folder and the settings of a caller's session."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from gridmart import session


def test_cluster_without_a_shared_folder_is_an_error(monkeypatch):
    class Conf:
        def get(self, key):
            return None

    def spark(master):
        context = SimpleNamespace(
            master=master,
            applicationId=f"app-{master}",
            getConf=Conf,
            getCheckpointDir=lambda: None,
        )
        return SimpleNamespace(sparkContext=context)

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://host"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.work_folder(spark(master))
    assert session.work_folder(spark("local[4]"))


def test_tune_leaves_the_overwrite_mode_alone(spark):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    session.tune(spark)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before == "STATIC"


def test_stored_by_season_makes_few_files(spark):
    rows = spark.range(0, 4000, 1, 16).withColumn("season", F.col("id") % 8)
    copy = session.stored(rows, "few-files", "season")
    assert len(copy.inputFiles()) < 16 * 8 / 2
    assert copy.agg(F.sum("id")).first()[0] == sum(range(4000))


def test_release_deletes_what_was_stored(spark, monkeypatch):
    monkeypatch.setattr(session, "_made", {})
    copy = session.stored(spark.range(3), "released")
    path = copy.inputFiles()[0]
    assert session.release(spark) >= 1
    assert session.release(spark) == 0
    with pytest.raises(Exception, match="(?i)exist|not.found|FILE"):
        spark.read.parquet(path).count()


def test_only_named_work_folders_are_discarded(spark):
    from gridmart.session import discard, new_work_path, work_paths

    one, two = (new_work_path(spark, n) for n in ("one", "two"))
    for path in (one, two):
        spark.range(2).write.parquet(path)
    discard(spark, [one])
    assert one not in work_paths(spark) and two in work_paths(spark)
    assert spark.read.parquet(two).count() == 2
    discard(spark, [two])


def test_a_copy_by_key_leaves_no_shuffle_files(spark):
    """Rows that need not be rebalanced are not shuffled, and files of a shuffle go when the copy is written."""
    from gridmart.session import stored

    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    rows = spark.range(1000).selectExpr("id", "id % 3 AS k")
    counts = []
    for rebalance in (True, False):
        before = tracker.shuffleStatuses().size()
        assert sorted(map(tuple, stored(rows, "by-key", "k", rebalance).collect())) == sorted(map(tuple, rows.collect()))
        counts.append(tracker.shuffleStatuses().size() - before)
    assert counts[0] <= 0 and counts[1] <= 0
