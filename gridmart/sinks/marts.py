"""Stored tables of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def save_mart(
    df: DataFrame, path: str, partition_by: str | None = "season", rebalance: bool = True
) -> DataFrame:
    """Write a table as Parquet and read it back.

    Tables with a season are partitioned by it, so season filters and the
    chronological split read only their folders. The rebalance hint lets AQE
    split a season that holds most of the rows and merge small ones. Without ``rebalance`` rows stay where they are:
    right for rows that are read from folders by season and have not been shuffled since, as
    each task then has rows of one season or a few.
    """
    by_season = bool(partition_by) and partition_by in df.columns
    rows = df
    if rebalance:
        rows = df.hint("rebalance", partition_by) if by_season else df.hint("rebalance")
    writer = rows.write.partitionBy(partition_by) if by_season else rows.write
    writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def publish(spark: SparkSession, folder: str, names: list[str], database: str) -> None:
    """Let ``database.name`` show the stored frames ``folder/name``.

    For a folder of its own per build: until it is complete and checked, the names show the build
    before, and a build that fails changes nothing. Each name is a view over its folder, replaced in one
    statement, so it is there at every moment. A table of that name, from a time before views, is dropped first.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    tables = {t.name.lower() for t in spark.catalog.listTables(database) if t.tableType not in ("VIEW", "TEMPORARY")}
    for name in names:
        path = f"{folder.rstrip('/')}/{name}"
        columns = spark.read.parquet(path).columns  # fails before anything is changed
        if name.lower() in tables:
            spark.sql(f"DROP TABLE {database}.{name}")
        place = path.replace("`", "``")
        shown = ", ".join("`" + c.replace("`", "``") + "`" for c in columns)
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT {shown} FROM parquet.`{place}`")
