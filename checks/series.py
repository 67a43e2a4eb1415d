"""Registered queries over time: as-of and overlap joins, running values, history, incremental facts, streams, rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from checks.oracle import model, with_tables
from checks.queries import _rounded, warehouse
from checks.registry import query
from gridmart.adapters import driver_tables as adapter
from gridmart.ml.train import train
from gridmart.operators import as_of_join, overlap_join, running
from gridmart.operators import sketches
from gridmart.plans import columns as C
from gridmart.plans import history, plays
from gridmart.plans.incremental import INPUTS, IncrementalFacts
from gridmart.session import discard, new_work_path, stored, tune, work_paths
from gridmart.sinks.raw import read_raw, replace_by_source_file
from gridmart.sources import flatten, stage
from gridmart.sources.staging import COLUMNS
from gridmart.streaming import landing

# --- series --------------------------------------------------------------------------------

@query(
    "asof_order",
    """SELECT e.event_id, e.user_id, o.o_orderkey AS last_orderkey, o.o_orderstatus AS last_status
       FROM (SELECT *, ts - INTERVAL 24 YEAR AS at FROM events) e
       ASOF LEFT JOIN (SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey,
           arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1, 2) o
       ON e.user_id = o.o_custkey AND e.at >= o.o_orderdate""",
)
def run_asof(spark, sf_dir):
    """Every event, moved into the years of the orders, with its user's last order until then."""
    events = adapter.read(tune(spark), sf_dir, "events").withColumn("at", F.expr("ts - INTERVAL 24 YEARS"))
    orders = adapter.read(spark, sf_dir, "orders")
    found = as_of_join(
        events, orders, {"user_id": "o_custkey"}, "at", "o_orderdate",
        {"last_orderkey": "o_orderkey", "last_status": "o_orderstatus"}, tiebreak=["o_orderkey"], rows=20_000,
    )
    return found.select("event_id", "user_id", "last_orderkey", "last_status")


_tracked = ", ".join(history.TRACKED)
_best = ", ".join(f"{c} ASC NULLS LAST" for c in history.TRACKED)
_roster_sql = {
    "observed": f"""SELECT player_id, seen, {_tracked} FROM (
        SELECT gsis_id AS player_id, CAST((season - 21) * 100 + week AS BIGINT) AS seen, {_tracked}, row_number() OVER (
          PARTITION BY gsis_id, season, week ORDER BY {_best}) AS place
        FROM stg_roster_weekly WHERE gsis_id IS NOT NULL AND season IS NOT NULL AND week IS NOT NULL) AS r
      WHERE place = 1""",
}
_roles = ("passer", "rusher", "receiver")


def _rosters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rosters of the test tables, moved into the seasons of their plays."""
    rosters = adapter.sources(tune(spark), sf_dir)["stg_roster_weekly"]
    return rosters.withColumn("season", F.col("season") - 21)


@query(
    "roster_at_play",
    with_tables(
        "SELECT p.game_id, p.play_id, p.player_id, "
        + ", ".join(f"CAST(p.role = '{r}' AS INT) AS is_{r}" for r in _roles)
        + ", o.seen AS roster_at, "
        + ", ".join(f"o.{c} AS roster_{c}" for c in history.TRACKED)
        + " FROM people p ASOF LEFT JOIN observed o ON p.player_id = o.player_id AND p.moment >= o.seen",
        _roster_sql
        | {
            "people": " UNION ALL ".join(
                f"SELECT game_id, play_id, '{r}' AS role, {r}_player_id AS player_id, "
                "CAST(season * 100 + nfl_week AS BIGINT) AS moment FROM stg_play_by_play "
                f"WHERE {r}_player_id IS NOT NULL"
                for r in _roles
            ),
        },
    ),
)
def run_roster_at_play(spark, sf_dir):
    """Every player of every play with the roster row that was valid then."""
    columns = ["game_id", "play_id", "season", "nfl_week", *[f"{r}_player_id" for r in _roles]]
    some = adapter.sources(tune(spark), sf_dir, columns)["stg_play_by_play"]
    return history.roster_at_play(some, _rosters(spark, sf_dir))


@query(
    "player_history",
    with_tables(
        f"""SELECT player_id, valid_from, lead(valid_from) OVER (PARTITION BY player_id ORDER BY valid_from) AS valid_to,
          lead(valid_from) OVER (PARTITION BY player_id ORDER BY valid_from) IS NULL AS is_current, {_tracked}, weeks
        FROM (SELECT player_id, spell, min(seen) AS valid_from, {', '.join(f'any_value({c}) AS {c}' for c in history.TRACKED)},
                count(*) AS weeks FROM numbered GROUP BY player_id, spell) AS s""",
        _roster_sql
        | {
            "marked": f"""SELECT *, CASE WHEN row_number() OVER w > 1 AND {' AND '.join(
                f'lag({c}) OVER w IS NOT DISTINCT FROM {c}' for c in history.TRACKED)} THEN 0 ELSE 1 END AS changed
                FROM observed WINDOW w AS (PARTITION BY player_id ORDER BY seen)""",
            "numbered": "SELECT *, sum(changed) OVER (PARTITION BY player_id ORDER BY seen) AS spell FROM marked",
        },
    ),
)
def run_player_history(spark, sf_dir):
    """Spells of all players, from roster rows that arrive in three lots with the latest weeks first."""
    rosters, path = _rosters(spark, sf_dir), new_work_path(spark, "history")
    for lot in (2, 0, 1):
        history.update_history(spark, path, rosters.filter(F.col("week") % 3 == lot), buckets=8)
    return history.read_history(spark, path).drop("row_hash").withColumn("weeks", F.size("weeks").cast("bigint"))


@query(
    "overlapping_shipments",
    """SELECT a.l_suppkey, count(*) AS pairs,
         CAST(sum(date_diff('day', greatest(a.s, b.s), least(a.e, b.e))) AS BIGINT) AS days
       FROM (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS s, CAST(l_shipdate AS DATE) + CAST(l_quantity AS INT) AS e
             FROM lineitem WHERE l_returnflag = 'R') a
       JOIN (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS s, CAST(l_shipdate AS DATE) + CAST(l_tax * 100 AS INT) AS e
             FROM lineitem WHERE l_returnflag = 'A') b
       ON a.l_suppkey = b.l_suppkey AND a.s < b.e AND b.s < a.e AND a.s < a.e AND b.s < b.e GROUP BY 1""",
)
def run_overlaps(spark, sf_dir):
    """Per supplier the shipments of one kind under way (as many days as items) while one of the other kind was."""
    lines = adapter.read(tune(spark), sf_dir, "lineitem").withColumn("began", F.to_date("l_shipdate"))

    def shipped(kind: str, days: str) -> DataFrame:
        own = lines.filter(F.col("l_returnflag") == kind)
        return own.select("l_suppkey", "began", F.date_add("began", F.expr(days)).alias("ended"))

    span = ("began", "ended")
    pairs = overlap_join(
        shipped("R", "CAST(l_quantity AS INT)"),
        shipped("A", "CAST(round(l_tax * 100) AS INT)"),
        {"l_suppkey": "l_suppkey"}, span, span,
        {"l_suppkey": "left.l_suppkey", "from": "start", "to": "end"},
    )
    return pairs.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("pairs"), F.sum(F.col("to") - F.col("from")).alias("days"))


@query(
    "running_by_flag",
    """SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(sum(CAST(l_quantity AS BIGINT)) OVER w AS BIGINT) AS shipped, count(nullif(l_linenumber, 1)) OVER w AS later_lines,
         max(l_extendedprice) OVER w AS dearest, last_value(nullif(l_linenumber, 1) IGNORE NULLS) OVER w AS last_later
       FROM lineitem WINDOW w AS (PARTITION BY l_returnflag
         ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def run_running(spark, sf_dir):
    """Running values of all lines of each return flag: three groups with a third of the rows each."""
    lines = adapter.read(tune(spark), sf_dir, "lineitem").withColumns(
        {"items": F.col("l_quantity").cast("bigint"), "later": F.expr("nullif(l_linenumber, 1)")}
    )
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    found = running(
        lines, ["l_returnflag"], order,
        {"shipped": ("sum", "items"), "later_lines": ("count", "later"), "dearest": ("max", "l_extendedprice"),
         "last_later": ("last", "later")},
        rows=5_000,
    )
    kept = ["l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return found.select(*kept, "shipped", "later_lines", "dearest", "last_later")


_STATE = "plays_so_far yards_so_far touchdowns_so_far drive_so_far last_down".split()


@query(
    "play_running_state",
    with_tables(
        """SELECT game_id, play_id, count(*) OVER w AS plays_so_far, sum(yards_gained) OVER w AS yards_so_far,
             sum(coalesce(touchdown, 0)) OVER w AS touchdowns_so_far, max(drive) OVER w AS drive_so_far,
             last_value(down IGNORE NULLS) OVER w AS last_down
           FROM stg_play_by_play WHERE game_id IS NOT NULL AND play_id IS NOT NULL
           WINDOW w AS (PARTITION BY game_id ORDER BY play_id NULLS FIRST, drive NULLS FIRST,
             down NULLS FIRST, yards_gained NULLS FIRST, coalesce(touchdown, 0) ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
    ),
)
def run_state(spark, sf_dir):
    columns = ["game_id", "play_id", "drive", "down", "yards_gained", "touchdown"]
    return plays.running_state(adapter.sources(tune(spark), sf_dir, columns)["stg_play_by_play"])


# --- incremental facts ---------------------------------------------------------------------

_PARTS = {"fct_game": "game_states", "fct_drive": "drive_states", "fct_player_game": "player_states"}


def _incremental(name: str):
    digits = {"epa_sum": 6}
    columns = {"fct_game": C.FCT_GAME, "fct_drive": C.FCT_DRIVE, "fct_player_game": C.FCT_PLAYER_GAME}[name]
    rates = {"success_rate": 9} if "success_rate" in columns else {}

    @query(f"incremental_{name}", model(name, columns, digits | rates))
    def run(spark, sf_dir):
        """The fact after a file was added, one changed, and one removed, against the model of all plays."""
        wide = warehouse(spark, sf_dir, name)
        known = wide.sources["stg_play_by_play"].select(*INPUTS[_PARTS[name]])
        file = F.concat(F.lit("pbp/play_by_play_"), F.col("season").cast("string"), F.lit(".parquet"))
        others = work_paths(spark)
        whole = stored(known.withColumn("source_file", file), "plays-by-file", partition_by="source_file", rebalance=False)
        landed = [p for p in work_paths(spark) if p not in others]
        keys = sorted(r[0] for r in whole.select("source_file").distinct().collect())
        facts = IncrementalFacts(spark, new_work_path(spark, "incremental"), [_PARTS[name]])

        def first(wanted):
            """The last season is not there yet, the first has half of its plays, and one file is a mistake."""
            mistake = whole.filter(F.col("source_file") == keys[1]).withColumn("source_file", F.lit("pbp/mistake.parquet"))
            early = whole.filter((F.col("source_file") != keys[0]) | (F.col("play_id") % 2 == 0))
            return early.unionByName(mistake).filter(F.col("source_file").isin(wanted))

        codes = wide.dim_team_code
        facts.update({**dict.fromkeys(keys[:-1], "1"), "pbp/mistake.parquet": "1"}, first, codes)
        prints = {**dict.fromkeys(keys, "1"), keys[0]: "2"}
        changes = facts.update(prints, lambda wanted: whole.filter(F.col("source_file").isin(wanted)), codes)
        if changes.read != sorted({keys[0], keys[-1]}) or changes.removed != ["pbp/mistake.parquet"]:
            raise AssertionError(f"other files than the changed ones: {changes}")
        discard(spark, landed)
        result = {
            "fct_game": lambda: facts.fct_game(wide.game_base),
            "fct_drive": facts.fct_drive,
            "fct_player_game": lambda: facts.fct_player_game(wide.dim_game),
        }[name]()
        return _rounded(result, digits | rates)


for _name in _PARTS:
    _incremental(_name)

# --- staging -------------------------------------------------------------------------------


@query("staged_from_records", model("stg_games", COLUMNS["stg_games"]))
def run_staged_records(spark, sf_dir):
    """Games as landed records: names in capitals, numbers as fractions or text in every other season, NaN for missing
    temperatures; loaded, flattened and staged they are the games again."""
    games = adapter.sources(tune(spark), sf_dir)["stg_games"]
    odd = F.col("season") % 2 == 1
    kinds = dict(games.dtypes)

    def drifted(c: str):
        if kinds[c] in ("int", "bigint"):
            return F.col(c).cast("double" if c.endswith("score") else "string")
        if c == "temperature":
            return F.coalesce(c, F.lit(float("nan")))
        return F.col(c)

    def records(some: DataFrame, columns: list) -> DataFrame:
        return some.select(
            F.to_variant_object(F.struct(*columns)).alias("record"),
            F.lit("schedules").alias("source_dataset"),
            F.col("season").cast("int").alias("source_year"),
            F.current_timestamp().alias("loaded_at"),
            F.concat(F.lit("schedules/games_"), F.col("season").cast("string"), F.lit(".parquet")).alias("source_file"),
        )

    as_is = records(games.filter(~odd), [F.col(c).alias(c.upper()) for c in games.columns])
    other = records(games.filter(odd), [drifted(c).alias(c.upper()) for c in games.columns])
    path = new_work_path(spark, "raw-games")
    replace_by_source_file(as_is, path, [])
    replace_by_source_file(other, path, [])
    spelled = T.StructType([T.StructField(f.name.upper(), f.dataType) for f in games.schema])
    return stage(flatten(read_raw(spark, path), spelled), "stg_games").select(*COLUMNS["stg_games"])


# --- streams -------------------------------------------------------------------------------


@query(
    "event_sessions",
    """SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS started,
         strftime(max(ts) + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS closed, count(*) AS n_events,
         max(event_id) AS last_event
       FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM (
         SELECT *, CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 6 HOUR
           THEN 0 ELSE 1 END AS fresh FROM events) AS e) AS s
       GROUP BY user_id, session""",
)
def run_sessions(spark, sf_dir):
    """Sessions of a stream of event files, stopped and started again half-way; later files hold late events."""
    tune(spark)
    columns = ["event_id", "ts", "user_id"]
    events = adapter.read(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id")
    folder, out, check = (new_work_path(spark, n) for n in ("event-files", "sessions", "checkpoint"))
    # Every fifth event comes a day late. The last file has nothing but a mark of time, so that all sessions end.
    day = F.unix_date(F.to_date("ts")) + F.when(F.col("event_id") % 5 == 0, 1).otherwise(0)
    files = events.withColumn("file", F.concat(F.lit("part"), F.floor(day / 8).cast("string")))
    numbers = sorted(r[0] for r in files.select("file").distinct().collect())
    for k, number in enumerate(numbers):
        own = files.filter(F.col("file") == number).select(*columns)
        own.coalesce(1).write.mode("append").parquet(folder)
        if k == len(numbers) // 2:
            _stream(spark, folder, out, check, events)
    mark = events.agg(
        F.lit(None).cast(events.schema["event_id"].dataType).alias("event_id"),
        (F.max("ts") + F.expr("INTERVAL 30 DAYS")).alias("ts"),
        F.lit(None).cast(events.schema["user_id"].dataType).alias("user_id"),
    )
    mark.coalesce(1).write.mode("append").parquet(folder)
    _stream(spark, folder, out, check, events)
    shown = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("started", "closed")}
    return landing.versions.read(spark, out).drop("source_file").filter("last_event IS NOT NULL").withColumns(shown)


def _stream(spark: SparkSession, folder: str, out: str, check: str, events: DataFrame) -> None:
    rows = landing.files_of(spark, folder, events.schema, batch_files=1)
    measures = [F.count(F.lit(1)).alias("n_events"), F.max("event_id").alias("last_event")]
    found = landing.sessions(rows, ["user_id"], "ts", "6 hours", measures, delay="2 days")
    landing.land_sessions(found, out, check).awaitTermination()


# --- rollups -------------------------------------------------------------------------------

_SETS = [["season", "play_type", "team"], ["season", "play_type"], ["season"], ["play_type"], []]


def exact_per_set(some: DataFrame, keys: list[str]) -> DataFrame:
    """Per group of each grouping set the number of games and the yards around the median.

    Two aggregates that are joined: in one, the distinct games would have a digest of yards kept for every game of
    every group, and those of a large group merged one by one. The digests of each set are made apart: those of a set of
    few groups then stay in memory, and rows need not be sorted for them.
    """
    sets = [[F.col(c) for c in s] for s in _SETS]
    level = F.grouping_id().cast("bigint").alias("grouping_id")
    games = some.select(*keys, "game_id").distinct().groupingSets(sets, *[F.col(c) for c in keys]).agg(
        level, F.count_distinct("game_id").alias("exact_games")
    )
    spread = F.percentile_approx("yards_gained", [0.44, 0.56], 1_000_000).alias("middle")
    middle = None
    for one in _SETS:
        found = some.groupingSets([[F.col(c) for c in one]], *[F.col(c) for c in keys]).agg(level, spread)
        middle = found if middle is None else middle.unionByName(found)
    same = F.col("g.grouping_id") == F.col("m.grouping_id")
    for c in keys:
        same = same & F.col(f"g.{c}").eqNullSafe(F.col(f"m.{c}"))
    return games.alias("g").join(middle.alias("m"), same).select("g.*", "middle")


@query(
    "play_rollup",
    with_tables(
        """SELECT CAST(grouping(season, play_type, team) AS BIGINT) AS grouping_id, season, play_type, team,
             count(*) AS row_count, sum(yards_gained) AS yards, TRUE AS games_near, TRUE AS median_near
           FROM (SELECT season, play_type, posteam AS team, yards_gained FROM stg_play_by_play) AS p
           GROUP BY GROUPING SETS ((season, play_type, team), (season, play_type), (season), (play_type), ())"""
    ),
)
def run_rollup_of_states(spark, sf_dir):
    """Plays under five grouping sets from stored states; the estimates are held against exact values."""
    columns = ["season", "play_type", "posteam", "yards_gained", "game_id"]
    some = adapter.sources(tune(spark), sf_dir, columns)["stg_play_by_play"]
    some = stored(some.select("season", "play_type", F.col("posteam").alias("team"), "yards_gained", "game_id"), "plays")
    measures = sketches.Measures(
        sums={"yards": "yards_gained"}, distinct={"games": "game_id"}, quantiles={"median": ("yards_gained", 0.5)}
    )
    keys = ["season", "play_type", "team"]
    per_group = stored(sketches.states(some, keys, measures), "play-states")
    found = sketches.estimates(sketches.combined(per_group, keys, measures, _SETS), measures)
    exact = exact_per_set(some, keys)
    same = F.col("f.grouping_id") == F.col("e.grouping_id")
    for c in keys:
        same = same & F.col(f"f.{c}").eqNullSafe(F.col(f"e.{c}"))
    near = F.abs(F.col("games") - F.col("exact_games")) <= 1 + 0.08 * F.col("exact_games")
    within = F.col("median").between(F.col("middle")[0], F.col("middle")[1])
    return found.alias("f").join(exact.alias("e"), same).select(
        "f.grouping_id", *[f"f.{c}" for c in keys], "row_count", "yards",
        near.alias("games_near"), F.coalesce(within, F.col("median").isNull()).alias("median_near"),
    )


# --- results of the trained model ----------------------------------------------------------


def _trained(spark: SparkSession, sf_dir: str):
    return train(warehouse(spark, sf_dir).table("ml_play_success_features"), run_id="bench")


@query("trained_metrics")
def run_trained_metrics(spark, sf_dir):
    """All metrics of both models. An iterative fit has no SQL twin; it is tested against a Newton solver."""
    return _rounded(_trained(spark, sf_dir).metrics, {"metric_value": 6})


@query("trained_predictions")
def run_trained_predictions(spark, sf_dir):
    """Class and probability that the trained model gives to every play of the test season."""
    return _rounded(_trained(spark, sf_dir).predictions, {"predicted_success_probability": 6})
