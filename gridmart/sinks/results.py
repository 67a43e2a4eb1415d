"""Result tables of a training run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from gridmart.session import stored

METRICS_TABLE = "ml_play_success_model_metrics"
PREDICTIONS_TABLE = "ml_play_success_predictions"

# Columns and types of the result tables.
METRICS_SCHEMA = (
    "run_id string, model_name string, split_name string, metric_name string, "
    "metric_value double, metric_text string, created_at timestamp_ntz"
)
PREDICTIONS_SCHEMA = (
    "run_id string, model_name string, split_name string, game_id string, play_id bigint, "
    "season bigint, actual_is_successful_play bigint, predicted_is_successful_play bigint, "
    "predicted_success_probability double, created_at timestamp_ntz"
)


@dataclass(frozen=True)
class AppendResult:
    success: bool
    rows: int


def create_result_tables(spark: SparkSession, database: str | None = None) -> None:
    """Create both result tables where they do not exist yet."""
    prefix = f"{database}." if database else ""
    for table, columns in ((METRICS_TABLE, METRICS_SCHEMA), (PREDICTIONS_TABLE, PREDICTIONS_SCHEMA)):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}{table} ({columns}) USING parquet")


def append_result(df: DataFrame, table: str, run_id: str) -> AppendResult:
    """Append ``df`` to ``table`` as run ``run_id`` with one creation time for the write.

    The frame is computed once, into the work folder; its rows are counted there (from the footers) and
    then appended. An empty frame adds none.
    """
    spark = df.sparkSession
    target = spark.table(table)
    now = spark.sql("SELECT CAST(current_timestamp() AS timestamp_ntz)").first()[0]
    stamped = df.withColumn("run_id", F.lit(run_id)).withColumn(
        "created_at", F.lit(now).cast(T.TimestampNTZType())
    )
    rows = stamped.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields]
    )
    copy = stored(rows, "append")
    count = copy.count()
    if count:
        copy.write.mode("append").insertInto(table)
    return AppendResult(True, count)
