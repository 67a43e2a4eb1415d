"""Registered queries: every table of the star schema, every operator, every contract.

Each reads whole test tables. ``QUERIES`` maps a name to a function of (spark, sf_dir),
``ORACLE`` to the SQL that must give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.oracle import contract, cols, model, with_tables
from checks.registry import ORACLE, QUERIES, query  # noqa: F401
from gridmart.adapters import driver_tables as adapter
from gridmart.functions import flag
from gridmart.ml import spec
from gridmart.ml.metrics import binary_metrics, evaluate, metrics_long, roc_auc
from gridmart.ml.preprocess import apply_preprocess, fit_preprocess
from gridmart.ml.split import chrono_split, model_input
from gridmart.ml.train import dummy_prediction, fit, penalised_gradient, train
from gridmart.operators import (
    add_missing_members,
    conditional_rollup,
    exact_medians,
    latest_per_key,
    modes,
    primary_by_count,
    unpivot_roles,
    without_parent,
)
from gridmart.plans import columns as C
from gridmart.plans.dimensions import dim_date
from gridmart.plans.warehouse import Warehouse
from gridmart.quality import (
    CONTRACTS,
    accepted_values,
    check_model,
    count_violations,
    duplicate_keys,
    not_null,
    orphans,
    rule,
)
from gridmart.session import new_work_path, stored, tune
from gridmart.sinks.raw import read_raw, replace_by_source_file
from gridmart.sources import build_manifest, flatten, landing_status, year_range
from gridmart.sources.registry import DATASETS
from gridmart.sources.staging import COLUMNS

_CODED = ["posteam", "defteam"]
_PLAY = [c for c in C.FCT_PLAY if c in C.play_inputs()] + _CODED
# Play columns that a table needs; those not listed get all.
PLAY_COLUMNS = {
    **dict.fromkeys(["fct_play", "fct_game", "fct_player_game", "dim_player"], _PLAY),
    "dim_player_season": _PLAY,
    "fct_drive": _PLAY + C.DRIVE_INPUTS,
}


def warehouse(spark: SparkSession, sf_dir: str, table: str | None = None) -> Warehouse:
    return Warehouse(adapter.sources(tune(spark), sf_dir, PLAY_COLUMNS.get(table)))


# --- staged tables -------------------------------------------------------------------------

STAGED = {
    "stg_play_by_play": C.play_inputs(),
    **{name: columns for name, columns in COLUMNS.items() if columns},
}


def _staged(name: str):
    columns = STAGED[name]

    @query(name, model(name, columns))
    def run(spark, sf_dir):
        return adapter.sources(tune(spark), sf_dir)[name].select(*columns)


for _name in STAGED:
    _staged(_name)

# --- star schema ---------------------------------------------------------------------------

# Sums of fractions depend on the order of addition in the last digits.
MARTS = {
    "dim_franchise": (C.DIM_FRANCHISE, {}),
    "dim_team_code": (C.DIM_TEAM_CODE, {}),
    "dim_game": (C.DIM_GAME, {}),
    "dim_player": (C.DIM_PLAYER, {}),
    "dim_player_season": (C.DIM_PLAYER_SEASON, {}),
    "fct_play": (C.FCT_PLAY, {"epa": 6}),
    "fct_play_pass": (C.FCT_PLAY_PASS, {"epa": 6}),
    "fct_play_rush": (C.FCT_PLAY_RUSH, {"epa": 6}),
    "fct_play_kick": (C.FCT_PLAY_KICK, {"epa": 6}),
    "fct_play_penalty": (C.FCT_PLAY_PENALTY, {"epa": 6}),
    "fct_drive": (C.FCT_DRIVE, {"epa_sum": 6}),
    "fct_game": (C.FCT_GAME, {"epa_sum": 6}),
    "fct_player_game": (C.FCT_PLAYER_GAME, {"epa_sum": 6}),
    "ml_play_success_features": (C.FEATURES, {}),
}


def _rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def _mart(name: str):
    columns, digits = MARTS[name]

    @query(name, model(name, columns, digits))
    def run(spark, sf_dir):
        return _rounded(warehouse(spark, sf_dir, name).table(name), digits)


for _name in MARTS:
    _mart(_name)


@query(
    "dim_date",
    """WITH bounds AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi
         FROM orders),
       days AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
         INTERVAL 1 DAY)) AS DATE) AS d FROM bounds),
       played AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS games FROM orders GROUP BY 1)
       SELECT days.d AS date, CAST(strftime(days.d, '%Y%m%d') AS BIGINT) AS date_key,
         CAST(year(days.d) AS INT) AS year, CAST(quarter(days.d) AS INT) AS quarter,
         CAST(month(days.d) AS INT) AS month, monthname(days.d) AS month_name,
         CAST(day(days.d) AS INT) AS day, CAST(dayofweek(days.d) AS INT) AS day_of_week_num,
         dayname(days.d) AS day_of_week_name, CAST(weekofyear(days.d) AS INT) AS week_of_year,
         coalesce(played.games, 0) AS games
       FROM days LEFT JOIN played ON played.d = days.d""",
)
def run_dim_date(spark, sf_dir):
    """The calendar between the first and last game day, with the games of each day."""
    games = adapter.sources(tune(spark), sf_dir)["stg_games"]
    days = dim_date(games.agg(F.min("gameday").alias("first_day"), F.max("gameday").alias("last_day")))
    played = games.groupBy(F.col("gameday").alias("date")).agg(F.count(F.lit(1)).alias("games"))
    return days.join(played, "date", "left").fillna(0, ["games"])


# --- contracts -----------------------------------------------------------------------------


def _contract(name: str):
    @query(f"check_{name}", contract(name))
    def run(spark, sf_dir):
        return check_model(warehouse(spark, sf_dir, name).table, name)


for _name in CONTRACTS:
    if _name != "dim_date":
        _contract(_name)

# --- landing -------------------------------------------------------------------------------

_registry_sql = "(VALUES " + ", ".join(
    f"('{d}', '{stem}', '{prefix}', '{raw}', {str(single).lower()})"
    for d, stem, _, prefix, raw, single in DATASETS
) + ") AS r(dataset, file_stem, prefix, raw_table, single_file)"
_manifest_sql = f"""
    SELECT dataset, CASE WHEN single_file THEN NULL ELSE y END AS year, raw_table,
      CASE WHEN single_file THEN concat(prefix, '/', file_stem, '.parquet')
        ELSE concat(prefix, '/', file_stem, '_', CAST(y AS STRING), '.parquet') END AS source_key
    FROM {_registry_sql} JOIN
      (SELECT CAST(unnest(generate_series(min(year(o_orderdate)), max(year(o_orderdate)))) AS INT) AS y
       FROM orders) AS years
    ON NOT single_file OR y = (SELECT min(year(o_orderdate)) FROM orders)"""


def _order_years(spark, sf_dir):
    years = adapter.read(spark, sf_dir, "orders").agg(
        F.min(F.year("o_orderdate")).alias("first"), F.max(F.year("o_orderdate")).alias("last")
    )
    first, last = years.first()
    return year_range(spark, first, last)


@query("manifest", _manifest_sql)
def run_manifest(spark, sf_dir):
    """Files expected for the years the orders span."""
    files = build_manifest(_order_years(spark, sf_dir))
    return files.select("dataset", "year", "raw_table", "source_key")


@query(
    "landing_status",
    f"""WITH manifest AS ({_manifest_sql}),
       landed AS (SELECT DISTINCT concat('pbp/play_by_play_', CAST(year(l_shipdate) AS STRING), '.parquet') AS k
         FROM lineitem WHERE l_linestatus = 'F'
         UNION SELECT DISTINCT concat('weekly_rosters/roster_weekly_', CAST(year(o_orderdate) AS STRING), '.parquet')
         FROM orders),
       bad AS (SELECT concat('weekly_rosters/roster_weekly_', CAST(max(year(o_orderdate)) AS STRING), '.parquet') AS k
         FROM orders WHERE o_orderstatus = 'F')
       SELECT dataset, year, source_key, CASE WHEN source_key IN (SELECT k FROM bad) THEN 'failed'
         WHEN source_key IN (SELECT k FROM landed) THEN 'uploaded' ELSE 'missing' END AS status
       FROM manifest""",
)
def run_landing_status(spark, sf_dir):
    """Outcome of each expected file, the landed and failed ones told by the tables."""
    orders, lines = (adapter.read(spark, sf_dir, t) for t in ("orders", "lineitem"))

    def key(stem, year):
        return F.concat(F.lit(stem), year.cast("string"), F.lit(".parquet")).alias("source_key")

    roster = "weekly_rosters/roster_weekly_"
    landed = (
        lines.filter("l_linestatus = 'F'")
        .select(key("pbp/play_by_play_", F.year("l_shipdate")))
        .unionByName(orders.select(key(roster, F.year("o_orderdate"))))
    )
    failures = orders.filter("o_orderstatus = 'F'").agg(
        key(roster, F.max(F.year("o_orderdate")))
    )
    files = build_manifest(_order_years(spark, sf_dir))
    return landing_status(files, landed, failures).select("dataset", "year", "source_key", "status")


@query(
    "raw_reload",
    """SELECT concat('orders/orders_', CAST(year(o_orderdate) AS STRING), '.parquet') AS source_file,
         CAST(year(o_orderdate) AS INT) AS source_year, count(*) AS records,
         CAST(sum(o_custkey) AS BIGINT) AS customers, max(o_orderpriority) AS top_priority
       FROM orders GROUP BY 1, 2""",
)
def run_raw_reload(spark, sf_dir):
    """Orders landed as one file per year, the latest year loaded twice; then flattened."""
    orders = adapter.read(spark, sf_dir, "orders")
    year = F.year("o_orderdate")
    records = orders.select(
        F.to_variant_object(F.struct(*orders.columns)).alias("record"),
        F.lit("orders").alias("source_dataset"),
        year.alias("source_year"),
        F.current_timestamp().alias("loaded_at"),
        F.concat(F.lit("orders/orders_"), year.cast("string"), F.lit(".parquet")).alias(
            "source_file"
        ),
    )
    path = new_work_path(spark, "raw-orders")
    replace_by_source_file(records, path, [])
    last = orders.agg(F.max(year)).first()[0]
    again = records.filter(F.col("source_year") == last)
    replace_by_source_file(again, path, [f"orders/orders_{last}.parquet"])
    return (
        flatten(read_raw(spark, path), orders.select("o_custkey", "o_orderpriority").schema)
        .groupBy("source_file", "source_year")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.sum("o_custkey").alias("customers"),
            F.max("o_orderpriority").alias("top_priority"),
        )
    )


@query(
    "flatten_records",
    """SELECT event_type AS source_dataset, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
         count(*) AS n FROM events GROUP BY 1, 2""",
)
def run_flatten(spark, sf_dir):
    """Semi-structured event properties as a typed column."""
    events = adapter.read(spark, sf_dir, "events")
    raw = events.select(
        F.parse_json("props").alias("record"), F.col("event_type").alias("source_dataset")
    )
    typed = flatten(raw, spark.createDataFrame([], "k bigint").schema)
    return typed.groupBy("source_dataset", "k").agg(F.count(F.lit(1)).alias("n"))


# --- operators on the plain tables ---------------------------------------------------------


@query(
    "latest_per_key",
    """SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM (SELECT *, row_number() OVER (
         PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey ASC) AS place
       FROM orders) AS o WHERE place = 1""",
)
def run_latest(spark, sf_dir):
    orders = adapter.read(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    return latest_per_key(orders, ["o_custkey"], ["o_orderdate"], ["o_orderkey"]).drop(
        "o_orderdate"
    )


@query(
    "primary_by_count",
    """SELECT l_orderkey, s_nationkey, candidate_count, last_line FROM (
         SELECT l_orderkey, s_nationkey, count(*) AS candidate_count, max(l_linenumber) AS last_line,
           row_number() OVER (PARTITION BY l_orderkey
             ORDER BY count(*) DESC, max(l_linenumber) DESC, s_nationkey ASC NULLS LAST) AS place
         FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_orderkey, s_nationkey) AS c
       WHERE place = 1""",
)
def run_primary(spark, sf_dir):
    """Main supplier nation of every order."""
    lines = adapter.read(spark, sf_dir, "lineitem")
    supplier = adapter.read(spark, sf_dir, "supplier")
    joined = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return primary_by_count(
        joined, ["l_orderkey"], "s_nationkey", then_desc={"last_line": F.max("l_linenumber")}
    )


@query(
    "count_distinct_max",
    """SELECT user_id, event_type, count(DISTINCT CAST(ts AS DATE)) AS days, max(value) AS top
       FROM events GROUP BY user_id, event_type""",
)
def run_count_distinct(spark, sf_dir):
    events = adapter.read(spark, sf_dir, "events")
    return events.groupBy("user_id", "event_type").agg(
        F.count_distinct(F.to_date("ts")).alias("days"), F.max("value").alias("top")
    )


@query(
    "role_unpivot",
    """SELECT l_orderkey, l_linenumber, l_partkey AS id, 1 AS is_part, 0 AS is_supplier FROM lineitem
       UNION ALL
       SELECT l_orderkey, l_linenumber, nullif(l_suppkey, 0), 0, 1 FROM lineitem WHERE l_suppkey <> 0""",
)
def run_roles(spark, sf_dir):
    lines = adapter.read(spark, sf_dir, "lineitem").withColumn(
        "l_suppkey", F.nullif("l_suppkey", F.lit(0))
    )
    roles = {"part": "l_partkey", "supplier": "l_suppkey"}
    return unpivot_roles(lines, roles, ["l_orderkey", "l_linenumber"], "id")


@query(
    "conditional_rollup",
    """SELECT l_suppkey, count(*) AS line_count, count(*) FILTER (WHERE l_returnflag = 'R') AS returned,
         sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS returned_quantity,
         round(avg(l_discount) FILTER (WHERE l_returnflag = 'R'), 6) AS returned_discount,
         max(l_quantity) FILTER (WHERE l_linestatus = 'F') AS largest_done
       FROM lineitem GROUP BY l_suppkey""",
)
def run_rollup(spark, sf_dir):
    returned = F.col("l_returnflag") == "R"
    rolled = conditional_rollup(
        adapter.read(spark, sf_dir, "lineitem"),
        ["l_suppkey"],
        {
            "line_count": ("count", None, None),
            "returned": ("count", returned, None),
            "returned_quantity": ("sum", returned, "l_quantity"),
            "returned_discount": ("avg", returned, "l_discount"),
            "largest_done": ("max", F.col("l_linestatus") == "F", "l_quantity"),
        },
    )
    return _rounded(rolled, {"returned_discount": 6})


@query(
    "missing_members",
    """SELECT d.doc_id, l.quality, l.toxic FROM (SELECT doc_id FROM documents
         UNION SELECT doc_id FROM labels) d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def run_missing(spark, sf_dir):
    """Labels, completed by a bare row for every unlabelled document."""
    labels = adapter.read(spark, sf_dir, "labels")
    return add_missing_members(labels, adapter.read(spark, sf_dir, "documents"), "doc_id")


@query(
    "anti_join",
    """SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (
         SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def run_anti(spark, sf_dir):
    urgent = adapter.read(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    customer = adapter.read(spark, sf_dir, "customer")
    return without_parent(customer, urgent, {"c_custkey": "o_custkey"}).select(
        "c_custkey", "c_mktsegment"
    )


@query(
    "duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def run_duplicates(spark, sf_dir):
    return duplicate_keys(adapter.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "orphan_check",
    """SELECT l_orderkey, count(*) AS row_count FROM lineitem WHERE NOT EXISTS (
         SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')
       GROUP BY l_orderkey""",
)
def run_orphans(spark, sf_dir):
    """Lines whose order is not among the finished ones."""
    done = adapter.read(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    return orphans(adapter.read(spark, sf_dir, "lineitem"), done, {"l_orderkey": "o_orderkey"})


@query(
    "row_checks",
    """SELECT 'not_null:quality' AS check_name, 'documents' AS model,
         count(*) FILTER (WHERE quality IS NULL) AS violations
       FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
       UNION ALL SELECT 'accepted_values:lang', 'documents', count(*) FROM documents
         WHERE lang NOT IN ('en', 'de')
       UNION ALL SELECT 'rule:long_toxic', 'documents', count(*)
         FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE toxic = 1 AND n_chars > 500""",
)
def run_row_checks(spark, sf_dir):
    docs = adapter.read(spark, sf_dir, "documents").join(
        adapter.read(spark, sf_dir, "labels"), "doc_id", "left"
    )
    return count_violations(
        docs,
        "documents",
        {
            "not_null:quality": not_null("quality"),
            "accepted_values:lang": accepted_values("lang", ["en", "de"]),
            "rule:long_toxic": rule((F.col("toxic") == 1) & (F.col("n_chars") > 500)),
        },
    )


@query(
    "flag_filter",
    """SELECT d.doc_id, d.lang FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
       WHERE coalesce(l.toxic, 0) = 0""",
)
def run_flags(spark, sf_dir):
    docs = adapter.read(spark, sf_dir, "documents").join(
        adapter.read(spark, sf_dir, "labels"), "doc_id", "left"
    )
    return docs.filter(flag("toxic") == 0).select("doc_id", "lang")


# --- model building ------------------------------------------------------------------------


@query(
    "chrono_split",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS season,
         CASE dense_rank() OVER (ORDER BY year(o_orderdate) DESC) WHEN 1 THEN 'test'
           WHEN 2 THEN 'validation' ELSE 'train' END AS split FROM orders""",
)
def run_split(spark, sf_dir):
    orders = adapter.read(spark, sf_dir, "orders")
    return chrono_split(orders.select("o_orderkey", F.year("o_orderdate").alias("season")))


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "exact_medians",
    " UNION ALL ".join(f"SELECT '{c}' AS column, median({c}) AS median FROM lineitem" for c in MEASURES),
)
def run_medians(spark, sf_dir):
    return exact_medians(adapter.read(spark, sf_dir, "lineitem"), MEASURES)


WORDS = ["l_returnflag", "l_linestatus", "l_linenumber"]


@query(
    "modes",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column, m AS mode FROM (SELECT CAST({c} AS STRING) AS m, count(*) AS n "
        f"FROM lineitem GROUP BY 1 ORDER BY n DESC, m LIMIT 1) AS t"
        for c in WORDS
    ),
)
def run_modes(spark, sf_dir):
    return modes(adapter.read(spark, sf_dir, "lineitem"), WORDS)


_split_sql = """SELECT f.*, CASE dense_rank() OVER (ORDER BY season DESC) WHEN 1 THEN 'test'
    WHEN 2 THEN 'validation' ELSE 'train' END AS split FROM ml_play_success_features f"""
_fit_sql = {
    "parted": _split_sql,
    "medians": "SELECT " + ", ".join(f"median({c}) AS {c}" for c in spec.NUMERIC)
    + " FROM parted WHERE split = 'train'",
    "words": "SELECT " + ", ".join(
        f"(SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM parted WHERE split = 'train' "
        f"AND {c} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 1) AS t) AS {c}"
        for c in spec.CATEGORICAL
    ),
}
_stats_sql = {
    **_fit_sql,
    "stats": "SELECT " + ", ".join(
        f"avg(coalesce(p.{c}, m.{c})) AS mean_{c}, stddev_pop(coalesce(p.{c}, m.{c})) AS std_{c}"
        for c in spec.NUMERIC
    )
    + " FROM parted p CROSS JOIN medians m WHERE split = 'train'",
}
READY = ["score_differential", "temperature", "wind", "ydstogo"]


def _prepared(spark, sf_dir):
    features = warehouse(spark, sf_dir).table("ml_play_success_features")
    split = chrono_split(stored(model_input(features), "features", "season"))
    return split, fit_preprocess(
        split.filter("split = 'train'"), spec.NUMERIC, spec.CATEGORICAL
    )


@query(
    "standardize",
    with_tables(
        "SELECT game_id, play_id, split, "
        + ", ".join(
            f"round((coalesce(p.{c}, m.{c}) - s.mean_{c}) / s.std_{c}, 4) AS {c}_ready" for c in READY
        )
        + ", coalesce(p.roof, w.roof) AS roof_ready, coalesce(p.surface, w.surface) AS surface_ready"
        " FROM parted p CROSS JOIN medians m CROSS JOIN stats s CROSS JOIN words w",
        _stats_sql,
    ),
)
def run_standardize(spark, sf_dir):
    """Features filled and standardised by what the training seasons show."""
    split, fitted = _prepared(spark, sf_dir)
    ready = apply_preprocess(split, fitted)
    return ready.select(
        "game_id",
        "play_id",
        "split",
        *[F.round(f"{c}_ready", 4).alias(f"{c}_ready") for c in READY],
        "roof_ready",
        "surface_ready",
    )


@query(
    "dummy_baseline",
    with_tables(
        """SELECT split, count(*) AS plays, CAST(min(g) AS INT) AS guess,
             round(avg(CASE WHEN is_successful_play = g THEN 1.0 ELSE 0.0 END), 6) AS accuracy
           FROM parted CROSS JOIN (SELECT is_successful_play AS g FROM parted WHERE split = 'train'
             GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS t GROUP BY split""",
        {"parted": _split_sql},
    ),
)
def run_dummy(spark, sf_dir):
    features = warehouse(spark, sf_dir).table("ml_play_success_features")
    split = chrono_split(
        stored(features.select("season", spec.TARGET), "targets", "season")
    )
    guess = dummy_prediction(split.filter("split = 'train'"))
    scored = split.withColumn("guess", F.lit(guess).cast("int"))
    accuracy = binary_metrics(scored, spec.TARGET, "guess", ["split", "guess"])
    plays = scored.groupBy("split").agg(F.count(F.lit(1)).alias("plays"))
    return accuracy.join(plays, "split").select(
        "split", "plays", "guess", F.round("accuracy", 6).alias("accuracy")
    )


_scored_sql = {
    "scored": """SELECT d.lang, l.quality AS a, CASE WHEN d.n_chars > 800 THEN 1 ELSE 0 END AS p,
      d.n_chars AS s FROM documents d JOIN labels l ON l.doc_id = d.doc_id""",
    "cells": """SELECT lang, count(*) FILTER (WHERE a = 0 AND p = 0) AS tn,
      count(*) FILTER (WHERE a = 0 AND p = 1) AS fp, count(*) FILTER (WHERE a = 1 AND p = 0) AS fn,
      count(*) FILTER (WHERE a = 1 AND p = 1) AS tp FROM scored GROUP BY lang""",
    "ranked": """SELECT lang, a, rank() OVER (PARTITION BY lang ORDER BY s)
      + (count(*) OVER (PARTITION BY lang, s) - 1) / 2.0 AS r FROM scored""",
    "areas": """SELECT lang, CASE WHEN count(DISTINCT a) = 2 THEN
      CAST(sum(r) FILTER (WHERE a = 1) - count(*) FILTER (WHERE a = 1) *
        (count(*) FILTER (WHERE a = 1) + 1) / 2.0 AS DOUBLE)
      / (CAST(count(*) FILTER (WHERE a = 1) AS DOUBLE) * count(*) FILTER (WHERE a = 0)) END AS roc_auc
      FROM ranked GROUP BY lang""",
    "wide": """SELECT lang, CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy,
      CASE WHEN tp + fp = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
      CASE WHEN tp + fn = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
      CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END AS f1,
      concat('[[', tn, ', ', fp, '], [', fn, ', ', tp, ']]') AS confusion_matrix FROM cells""",
}
RATES = ["accuracy", "precision", "recall", "f1"]


def _scored_documents(spark, sf_dir):
    return adapter.read(spark, sf_dir, "documents").join(
        adapter.read(spark, sf_dir, "labels"), "doc_id"
    ).select(
        "lang",
        F.col("quality").alias("a"),
        F.when(F.col("n_chars") > 800, 1).otherwise(0).alias("p"),
        F.col("n_chars").alias("s"),
    )


@query(
    "binary_metrics",
    with_tables(
        "SELECT lang, confusion_matrix, "
        + ", ".join(f"round({c}, 6) AS {c}" for c in RATES)
        + " FROM wide",
        _scored_sql,
    ),
)
def run_binary(spark, sf_dir):
    """Does length tell quality? Per language."""
    return _rounded(
        binary_metrics(_scored_documents(spark, sf_dir), "a", "p", ["lang"]),
        dict.fromkeys(RATES, 6),
    )


@query(
    "roc_auc",
    with_tables("SELECT lang, round(roc_auc, 6) AS roc_auc FROM areas", _scored_sql),
)
def run_auc(spark, sf_dir):
    return _rounded(
        roc_auc(_scored_documents(spark, sf_dir), "a", "s", ["lang"]), {"roc_auc": 6}
    )


@query(
    "metrics_long",
    with_tables(
        " UNION ALL ".join(
            f"SELECT lang, '{c}' AS metric_name, round({c}, 6) AS metric_value, "
            "CAST(NULL AS STRING) AS metric_text FROM "
            + ("areas" if c == "roc_auc" else "wide")
            for c in [*RATES, "roc_auc"]
        )
        + " UNION ALL SELECT lang, 'confusion_matrix', NULL, confusion_matrix FROM wide",
        _scored_sql,
    ),
)
def run_metrics_long(spark, sf_dir):
    wide = evaluate(_scored_documents(spark, sf_dir), "a", "p", "s", ["lang"])
    return _rounded(metrics_long(wide, ["lang"]), {"metric_value": 6})


_dummy_sql = {
    "parted": _split_sql,
    "guess": """SELECT is_successful_play AS g FROM parted WHERE split = 'train'
      GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1""",
    "cells": """SELECT count(*) FILTER (WHERE y = 0 AND g = 0) AS tn,
      count(*) FILTER (WHERE y = 0 AND g = 1) AS fp, count(*) FILTER (WHERE y = 1 AND g = 0) AS fn,
      count(*) FILTER (WHERE y = 1 AND g = 1) AS tp
      FROM (SELECT is_successful_play AS y, g FROM parted CROSS JOIN guess WHERE split = 'validation')""",
    "wide": """SELECT CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy,
      CASE WHEN tp + fp = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
      CASE WHEN tp + fn = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
      CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END AS f1,
      CASE WHEN tp + fn > 0 AND tn + fp > 0 THEN 0.5 END AS roc_auc,
      concat('[[', tn, ', ', fp, '], [', fn, ', ', tp, ']]') AS confusion_matrix FROM cells""",
}


@query(
    "model_metrics",
    with_tables(
        " UNION ALL ".join(
            f"SELECT 'bench' AS run_id, '{spec.DUMMY}' AS model_name, 'validation' AS split_name, "
            f"'{c}' AS metric_name, CAST(round({c}, 6) AS DOUBLE) AS metric_value, "
            "CAST(NULL AS STRING) AS metric_text FROM wide"
            for c in [*RATES, "roc_auc"]
        )
        + f" UNION ALL SELECT 'bench', '{spec.DUMMY}', 'validation', 'confusion_matrix', NULL, "
        "confusion_matrix FROM wide",
        _dummy_sql,
    ),
)
def run_model_metrics(spark, sf_dir):
    """Metrics of a training run. Those of the majority model have an SQL twin; model_fit proves the other."""
    run = train(warehouse(spark, sf_dir).table("ml_play_success_features"), run_id="bench")
    return _rounded(run.metrics.filter(F.col("model_name") == spec.DUMMY), {"metric_value": 6})


@query(
    "model_predictions",
    with_tables(
        f"SELECT 'bench' AS run_id, '{spec.LOGISTIC}' AS model_name, 'test' AS split_name, "
        "CAST(game_id AS STRING) AS game_id, CAST(play_id AS BIGINT) AS play_id, "
        "CAST(season AS BIGINT) AS season, "
        "CAST(is_successful_play AS BIGINT) AS actual_is_successful_play FROM parted WHERE split = 'test'",
        {"parted": _split_sql},
    ),
)
def run_model_predictions(spark, sf_dir):
    """Rows of the prediction table; what an iterative fit predicts has no SQL twin and is left out."""
    run = train(warehouse(spark, sf_dir).table("ml_play_success_features"), run_id="bench")
    predicted = ["predicted_is_successful_play", "predicted_success_probability"]
    return run.predictions.filter(
        "predicted_is_successful_play IN (0, 1) AND predicted_success_probability BETWEEN 0 AND 1"
    ).drop(*predicted)


@query(
    "model_fit",
    with_tables(
        "SELECT 'intercept' AS feature, CAST(0 AS DOUBLE) AS gradient "
        + " ".join(f"UNION ALL SELECT '{c}', 0" for c in spec.NUMERIC)
        + " ".join(
            f" UNION ALL SELECT DISTINCT concat('{c}=', coalesce(p.{c}, w.{c})), 0 "
            "FROM parted p CROSS JOIN words w WHERE split = 'train'"
            for c in spec.CATEGORICAL
        ),
        _fit_sql,
    ),
)
def run_model_fit(spark, sf_dir):
    """The fitted weights are where the penalised loss of all training rows has no slope."""
    features = warehouse(spark, sf_dir).table("ml_play_success_features")
    split = chrono_split(stored(model_input(features), "features", "season"))
    rows = split.filter("split = 'train'")
    slope = penalised_gradient(fit(rows), rows)
    return slope.select("feature", F.abs(F.round("gradient", 3)).alias("gradient"))
