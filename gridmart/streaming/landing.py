"""Landed files as a stream: loaded as they come, and sessions of their events.

The file source reads every new file once and remembers them in the checkpoint. A micro-batch that is repeated after a restart
writes the same keys again (`versions`), so rows are neither lost nor doubled, and readers see whole batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gridmart.sinks import versions

BATCH_FILES = 100


def files_of(
    spark: SparkSession, folder: str, schema: StructType, batch_files: int = BATCH_FILES, name: str = "*.parquet"
) -> DataFrame:
    """The rows of all Parquet files in ``folder``, as a stream, with their ``source_file``."""
    rows = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", batch_files)
        .option("pathGlobFilter", name)
        .parquet(folder)
    )
    return rows.withColumn(versions.KEY, F.element_at(F.split("_metadata.file_path", "/"), -1))


def land(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Load what has landed so far into the table at ``path``, file by file, and stop; run again to go on.

    A file is in one micro-batch as a whole, so its key is replaced as a whole.
    """

    def write(batch: DataFrame, number: int) -> None:
        keys = [r[0] for r in batch.select(versions.KEY).distinct().collect()]
        if keys:
            versions.replace(batch, path, keys)

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def sessions(
    events: DataFrame, keys: list[str], at: str, gap: str, measures: list[Column], delay: str | None = None
) -> DataFrame:
    """One row per session: events of a key with ``gap`` or less between neighbours.

    The same for a table and for a stream. A stream needs a ``delay``: events that come later than that behind the newest one
    are dropped, and a session is told once it can't grow any more. Rows without a time belong to no session.
    """
    timed = events.filter(F.col(at).isNotNull())
    if delay is not None:
        timed = timed.withWatermark(at, delay)
    window = F.session_window(at, gap).alias("session")
    # The end of Spark's session is the last event plus the gap.
    return timed.groupBy(window, *keys).agg(*measures).select(
        *keys, F.col("session.start").alias("started"), F.col("session.end").alias("closed"),
        *[c for c in _names(timed, keys, measures)],
    )


def _names(df: DataFrame, keys: list[str], measures: list[Column]) -> list[str]:
    probe = df.sparkSession.createDataFrame([], df.schema)
    return probe.groupBy(*keys).agg(*measures).columns[len(keys) :]


def land_sessions(found: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the sessions that are over to the table at ``path``: one key per micro-batch, so that a repeated
    batch replaces its own rows."""

    def write(batch: DataFrame, number: int) -> None:
        key = f"batch-{number:012d}"
        versions.replace(batch.withColumn(versions.KEY, F.lit(key)), path, [key])

    return (
        found.writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
