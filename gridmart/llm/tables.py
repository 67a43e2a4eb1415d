"""Reading inputs, and tables written to the shared folder between steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridmart.session import new_work_path, without_shuffles

__all__ = ["documents", "held_out", "keep", "keep_alone", "read_table"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the folder all executors share and read it back.

    Steps that need it several times read the copy, and a lost executor costs a re-read.
    """
    path = new_work_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep_alone(df: DataFrame, label: str, made: list[str]) -> DataFrame:
    """Like ``keep``; the shuffles that led to the copy are deleted, and ``made`` gets its folder for ``discard``.

    For chains of large steps, whose disk is then that of the largest and not of all together.
    """
    path = new_work_path(df.sparkSession, label)
    made.append(path)
    with without_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text leaves 2 by 4."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2
