"""Session settings the jobs are written for, and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets AQE split a hot game even where a join feeds an aggregate on the same key.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Projections of a hundred columns compile to methods the JVM refuses to optimise (over 8000
    # bytes); below this limit Spark uses its split-up projection instead, ten times faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_spark(app: str = "gridmart", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session made elsewhere, where it has none of its own."""
    given = {key for key, _ in spark.sparkContext.getConf().getAll()}
    for key, value in SETTINGS.items():
        if key not in given and key != "spark.sql.session.timeZone":
            spark.conf.set(key, value)
    return spark


_local_folders: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def work_folder(spark: SparkSession) -> str:
    """Folder shared by all executors: the cluster's ``spark.checkpoint.dir``.

    Where none is set, a session whose executors run inside the driver gets a temporary one;
    on a cluster that is an error, as executors would write to their own disks.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _local_folders:
            _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="gridmart-")
        folder = _local_folders[context.applicationId]
    return folder.rstrip("/")


def new_work_path(spark: SparkSession, label: str) -> str:
    path = f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def without_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs in here go at its end, and not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, label: str, partition_by: str | None = None, rebalance: bool = True) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut there.

    Unlike an RDD checkpoint the copy is columnar, so later passes read only
    the columns they need, and it outlives lost executors. With ``partition_by`` rows are rebalanced
    first, so that a folder gets a few files of good size and not one from every task; without ``rebalance``
    each task writes its own, and no row is shuffled.
    """
    spark = df.sparkSession
    path = new_work_path(spark, label)
    if partition_by:
        rows = df.hint("rebalance", partition_by) if rebalance else df
        with without_shuffles(spark):
            rows.write.option("compression", "zstd").partitionBy(partition_by).parquet(path)
    else:
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def work_paths(spark: SparkSession) -> list[str]:
    """Folders that this application has made by ``stored`` and ``new_work_path`` and not yet deleted."""
    return list(_made.get(spark.sparkContext.applicationId, []))


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete some work folders: frames that read them fail afterwards."""
    context, jvm = spark.sparkContext, spark.sparkContext._jvm
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    gone = set(paths)
    _made[context.applicationId] = [p for p in work_paths(spark) if p not in gone]


def release(spark: SparkSession) -> int:
    """Delete what this application has written by ``stored`` and ``new_work_path``.

    For the end of a job: frames that read these folders fail afterwards. Returns their number.
    """
    paths = work_paths(spark)
    discard(spark, paths)
    return len(paths)
