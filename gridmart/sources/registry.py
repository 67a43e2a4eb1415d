"""The datasets that are landed, and the files expected for a span of years."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

# One line per dataset; the storage prefix can differ from the release name.
DATASETS = [
    # dataset, file stem, release, storage prefix, raw table, one file for all years
    ("pbp", "play_by_play", "pbp", "pbp", "RAW_PLAY_BY_PLAY", False),
    ("schedules", "games", "schedules", "schedules", "RAW_GAMES", True),
    ("teams", "teams_colors_logos", "teams", "teams", "RAW_TEAMS_COLORS_LOGOS", True),
    ("player_stats", "player_stats", "player_stats", "player_stats", "RAW_PLAYER_STATS", False),
    (
        "weekly_rosters",
        "roster_weekly",
        "weekly_rosters",
        "weekly_rosters",
        "RAW_ROSTER_WEEKLY",
        False,
    ),
    ("stats_team", "stats_team_week", "stats_team", "stats_teams", "RAW_STATS_TEAM_WEEK", False),
]
FIRST_SEASON = 2000

REGISTRY_SCHEMA = (
    "dataset string, file_stem string, release string, prefix string, "
    "raw_table string, single_file boolean"
)
MANIFEST = "dataset file_stem year release prefix raw_table source_path source_key".split()


def registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DATASETS, REGISTRY_SCHEMA)


def year_range(spark: SparkSession, start: int = FIRST_SEASON, end: int | None = None) -> DataFrame:
    """One row per season year, both ends included."""
    end = date.today().year if end is None else end
    if start > end:
        raise ValueError(f"start year {start} is after end year {end}")
    return spark.range(start, end + 1).select(F.col("id").cast("int").alias("year"))


def build_manifest(years: DataFrame, table: str = "all") -> DataFrame:
    """One row per expected file: dataset x year, or one row with no year for single files.

    ``years`` is a frame with a distinct ``year`` column. Each year is expanded in place by the
    handful of yearly datasets; no join is involved.
    """
    names = [row[0] for row in DATASETS]
    if table != "all" and table not in names:
        raise ValueError(f"unknown dataset {table!r}; expected one of {names} or 'all'")
    chosen = [row for row in DATASETS if table in ("all", row[0])]
    yearly = [_entry(row) for row in chosen if not row[-1]]
    single = [row for row in chosen if row[-1]]
    year = F.col("year").cast("int").alias("year")
    parts = []
    if yearly:
        parts.append(years.select(year, F.inline(F.array(*yearly))))
    if single:
        fixed = years.sparkSession.createDataFrame(single, REGISTRY_SCHEMA)
        parts.append(fixed.withColumn("year", F.lit(None).cast("int")).drop("single_file"))
    stem = F.concat_ws("_", "file_stem", F.col("year").cast("string"))
    file_name = F.concat(stem, F.lit(".parquet"))
    return (
        reduce(DataFrame.unionByName, parts)
        .withColumn("source_path", F.concat_ws("/", "release", file_name))
        .withColumn("source_key", F.concat_ws("/", "prefix", file_name))
        .select(*MANIFEST)
    )


def _entry(row: tuple):
    fields = ["dataset", "file_stem", "release", "prefix", "raw_table"]
    return F.struct(*[F.lit(value).alias(name) for name, value in zip(fields, row)])
