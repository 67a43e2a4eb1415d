"""The batch from landed files to predictions.

    spark-submit gridmart/jobs.py --landing s3a://bucket/landing --out s3a://bucket/warehouse \\
        --table all --start-year 2000 --end-year 2024 --renames renames.json --build --train

Violated contracts stop the job before the training.
"""

from __future__ import annotations

import argparse
import json
import uuid
from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gridmart.ml.train import train_job
from gridmart.plans.warehouse import TABLES, Warehouse
from gridmart.quality import failed, run_checks
from gridmart.session import get_spark, release
from gridmart.sinks import create_result_tables, load_landed, save_mart
from gridmart.sinks.marts import publish
from gridmart.sinks.raw import read_raw, read_schema
from gridmart.sources import (
    build_manifest,
    flatten,
    landing_status,
    list_landed,
    read_seed,
    record_schema,
    require_no_failures,
    stage,
    year_range,
)
from gridmart.sources.registry import DATASETS, FIRST_SEASON

STAGED_FROM = {
    "stg_play_by_play": "RAW_PLAY_BY_PLAY",
    "stg_games": "RAW_GAMES",
    "stg_roster_weekly": "RAW_ROSTER_WEEKLY",
    "stg_teams_colors_logos": "RAW_TEAMS_COLORS_LOGOS",
    "stg_player_stats": "RAW_PLAYER_STATS",
    "stg_stats_team_week": "RAW_STATS_TEAM_WEEK",
}

NEEDED = ("stg_play_by_play", "stg_games", "stg_roster_weekly")


def ingest(
    spark: SparkSession,
    landing: str,
    raw: str,
    table: str = "all",
    start: int = FIRST_SEASON,
    end: int | None = None,
    failures: DataFrame | None = None,
    skip_unchanged: bool = False,
) -> dict[str, int]:
    """Load the landed files of a span of years. Any failed file stops the whole load;
    files that do not exist at the source are only reported, and with ``skip_unchanged`` those that are as they were at
    their last load are left alone. Returns files loaded per raw table."""
    manifest = build_manifest(year_range(spark, start, end), table)
    status = landing_status(manifest, list_landed(spark, landing), failures)
    print("landing:", require_no_failures(status))
    return load_landed(spark, status, landing, raw, skip_unchanged)


def staged(
    spark: SparkSession,
    raw: str,
    name: str,
    schema: T.StructType | None = None,
    renames: dict[str, str] | None = None,
) -> DataFrame:
    """A staged view over a raw table.

    The fields are ``schema``, else those kept when the files were loaded; only a table loaded by other
    means needs a pass over its records to find them.
    """
    table = STAGED_FROM[name]
    records = read_raw(spark, f"{raw.rstrip('/')}/{table}")
    schema = schema or read_schema(spark, raw, table) or record_schema(records)
    return stage(flatten(records, schema, renames), name)


def _has_raw(spark: SparkSession, raw: str, name: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{raw.rstrip('/')}/{STAGED_FROM[name]}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def build(
    spark: SparkSession,
    raw: str,
    out: str,
    schemas: dict[str, T.StructType] | None = None,
    renames: dict[str, dict[str, str]] | None = None,
    seeds: dict[str, str] | None = None,
) -> Warehouse:
    """All tables from the raw ones.

    Every staged source is parsed out of its records once and stored (by season where it has one). Plays,
    games and rosters are needed; the other sources are staged if they have been loaded. ``renames`` maps names
    in the files to staged ones per source, ``seeds`` gives paths of seed files other than the packaged ones.
    """
    schemas, renames, seeds = schemas or {}, renames or {}, seeds or {}
    sources = {}
    for name in STAGED_FROM:
        if name in NEEDED or _has_raw(spark, raw, name):
            view = staged(spark, raw, name, schemas.get(name), renames.get(name))
            sources[name] = save_mart(view, f"{out}/{name}")
    for name in ("map_team_code_seed", "dim_franchise_seed"):
        sources[name] = read_seed(spark, name, seeds.get(name))
    warehouse = Warehouse(sources, out, by_season=True)
    warehouse.build_all()
    return warehouse


def _json_file(path: str | None) -> dict:
    return json.loads(Path(path).read_text(encoding="utf-8")) if path else {}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--landing", required=True, help="root folder of the landed files")
    parser.add_argument("--out", required=True, help="root folder of raw and stored tables")
    parser.add_argument("--table", default="all", choices=[d[0] for d in DATASETS] + ["all"])
    parser.add_argument("--start-year", type=int, default=FIRST_SEASON)
    parser.add_argument("--end-year", type=int, default=date.today().year)
    parser.add_argument("--build", action="store_true", help="build and check the star schema")
    parser.add_argument("--train", action="store_true", help="train on the feature table")
    parser.add_argument(
        "--skip-unchanged", action="store_true", help="leave files alone that are as they were at their last load"
    )
    parser.add_argument(
        "--renames", help='JSON file: {"stg_games": {"name in the files": "staged name"}, ...}'
    )
    parser.add_argument("--schemas", help='JSON file: {"stg_games": "game_id string, ..."}')
    parser.add_argument("--seeds", help='JSON file: {"map_team_code_seed": "path of the CSV", ...}')
    parser.add_argument("--failures", help="text file or folder: a source_key per line that failed")
    parser.add_argument(
        "--database", help="build in a new folder and, if no contract is violated, show it as these tables"
    )
    parser.add_argument(
        "--train-anyway", action="store_true", help="train even if contracts are violated"
    )
    args = parser.parse_args(argv)
    spark = spark or get_spark()
    raw, marts = f"{args.out}/raw", f"{args.out}/marts"
    if args.database:
        marts = f"{marts}/{uuid.uuid4().hex}"
    failures = spark.read.text(args.failures).toDF("source_key") if args.failures else None
    years = (args.start_year, args.end_year)
    print("loaded:", ingest(spark, args.landing, raw, args.table, *years, failures, args.skip_unchanged))
    if not (args.build or args.train):
        return
    schemas = {name: T.DataType.fromDDL(ddl) for name, ddl in _json_file(args.schemas).items()}
    warehouse = build(
        spark, raw, marts, schemas, _json_file(args.renames), _json_file(args.seeds)
    )
    broken = failed(run_checks(warehouse.table)).collect()
    for row in broken:
        print("violated:", row["model"], row["check_name"], row["violations"])
    if args.database and not broken:
        publish(spark, marts, [*(n for n in STAGED_FROM if n in warehouse.sources), *TABLES], args.database)
    if args.train and (args.train_anyway or not broken):
        create_result_tables(spark)
        # Stored by season already.
        print("written:", train_job(warehouse.ml_play_success_features, copy=False))
    release(spark)
    if broken:
        raise SystemExit(f"{len(broken)} checks failed")


if __name__ == "__main__":
    main()
