"""Seed tables: team codes seen over the years, and the franchises they belong to."""

from __future__ import annotations

import csv
from importlib import resources

from pyspark.sql import DataFrame, SparkSession

SEEDS = {
    "map_team_code_seed": "source_team_code string, team_code string",
    "dim_franchise_seed": (
        "franchise_id string, franchise_name string, team_code string, "
        "conference string, division string"
    ),
}


def read_seed(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """A seed from ``path`` (CSV with header on shared storage) or the packaged one.

    The packaged files hold a few dozen rows and are shipped with the plan, as
    executors cannot read the driver's package folder.
    """
    schema = SEEDS[name]
    if path:
        return spark.read.schema(schema).option("header", True).option("comment", "#").csv(path)
    text = resources.files("gridmart.sources").joinpath("seed_data", f"{name}.csv").read_text()
    lines = [line for line in text.splitlines() if line and not line.startswith("#")]
    return spark.createDataFrame([tuple(row) for row in list(csv.reader(lines))[1:]], schema)
