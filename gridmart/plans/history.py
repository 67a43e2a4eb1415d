"""History of players' roster entries: one row per spell in which nothing tracked has changed (type 2).

Roster rows are observations at a position in time, ``season * 100 + week``. A player's observations in order are cut where the
hash of the tracked columns changes; a spell is valid from its first observation to the first of the next
spell. Late rows may split a spell or join two, so a spell keeps the weeks it was observed in (a career has a few
hundred), and merging new rows rebuilds the players that they name and no others. The result
does not depend on the order in which rows arrive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gridmart.operators import as_of_join, pick_order, unpivot_roles
from gridmart.plans.dimensions import PLAYER_ROLES
from gridmart.sinks import versions

TRACKED = ["team", "player_position", "jersey_number"]
BUCKETS = 64


def position(season: str = "season", week: str = "week") -> Column:
    return (F.col(season) * 100 + F.col(week)).cast("bigint")


def observations(rosters: DataFrame, tracked: list[str] = TRACKED) -> DataFrame:
    """``player_id, at`` and the tracked columns: one row per player and week.

    Of several rows of a week the least counts, column by column, NULLs last. Rows without player, season or week are
    left out.
    """
    rows = rosters.select(F.col("gsis_id").alias("player_id"), position().alias("at"), *tracked)
    return _one_per_week(rows.dropna(subset=["player_id", "at"]), tracked)


def _one_per_week(rows: DataFrame, tracked: list[str]) -> DataFrame:
    best = F.min_by(F.struct(*tracked), pick_order(rows, [], tracked)).alias("best")
    return rows.groupBy("player_id", "at").agg(best).select("player_id", "at", "best.*")


def spells(observed: DataFrame, tracked: list[str] = TRACKED) -> DataFrame:
    """``player_id, valid_from, valid_to, is_current``, the tracked columns, ``row_hash`` and ``weeks``.

    ``valid_to`` is the position at which the next spell begins, NULL for the current one. A player's group is bounded by the
    number of weeks, as observations are one per week.
    """
    row_hash = F.md5(F.to_json(F.struct(*tracked)))
    in_time = Window.partitionBy("player_id").orderBy("at")
    hashed = observed.withColumn("row_hash", row_hash)
    changed = (~F.lag("row_hash").over(in_time).eqNullSafe(F.col("row_hash"))).cast("int")
    numbered = hashed.withColumn("_changed", changed).withColumn("_spell", F.sum("_changed").over(in_time))
    whole = numbered.groupBy("player_id", "_spell").agg(
        F.min("at").alias("valid_from"),
        F.any_value("row_hash").alias("row_hash"),
        F.any_value(F.struct(*tracked)).alias("_row"),
        F.sort_array(F.collect_list("at")).alias("weeks"),
    )
    following = F.lead("valid_from").over(Window.partitionBy("player_id").orderBy("valid_from"))
    return whole.withColumn("valid_to", following).select(
        "player_id",
        "valid_from",
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
        "_row.*",
        "row_hash",
        "weeks",
    )


def merge(history: DataFrame, observed: DataFrame, tracked: list[str] = TRACKED) -> DataFrame:
    """The history with new observations put in, wherever in time they belong."""
    named = observed.select("player_id").distinct()
    before = history.join(named, "player_id", "left_semi").select("player_id", F.explode("weeks").alias("at"), *tracked)
    rebuilt = spells(_one_per_week(before.unionByName(observed), tracked), tracked)
    return history.join(named, "player_id", "left_anti").unionByName(rebuilt)


def _bucket(buckets: int) -> Column:
    return F.concat(F.lit("players-"), F.pmod(F.xxhash64("player_id"), F.lit(buckets)).cast("string"))


def update_history(
    spark: SparkSession, path: str, rosters: DataFrame, tracked: list[str] = TRACKED, buckets: int = BUCKETS
) -> list[str]:
    """Merge roster rows into the history stored at ``path``; returns the buckets of players that were read and written.

    Players are dealt to buckets by hash; only those of the new rows are touched, and readers see all of it or nothing.
    The number of buckets belongs to the stored history.
    """
    observed = observations(rosters, tracked).withColumn(versions.KEY, _bucket(buckets))
    touched = sorted(r[0] for r in observed.select(versions.KEY).distinct().collect())
    if not touched:
        return []
    new = observed.drop(versions.KEY)
    known = versions.current(spark, path) is not None
    before = read_history(spark, path, touched) if known else spells(new.limit(0), tracked)
    merged = merge(before, new, tracked)
    versions.replace(merged.withColumn(versions.KEY, _bucket(buckets)), path, touched)
    return touched


def read_history(spark: SparkSession, path: str, buckets: list[str] | None = None) -> DataFrame:
    return versions.read(spark, path, keys=buckets).drop(versions.KEY)


def roster_at_play(plays: DataFrame, rosters: DataFrame, tracked: list[str] = TRACKED) -> DataFrame:
    """Each player of a play with the roster row that was valid then: the last one of this or an earlier week.

    ``game_id, play_id, player_id``, a 0/1 column per role and ``roster_`` columns, NULL where there is none yet.
    """
    people = unpivot_roles(plays, PLAYER_ROLES, ["game_id", "play_id", "season", "nfl_week"])
    timed = people.withColumn("_at", position("season", "nfl_week")).drop("season", "nfl_week")
    found = as_of_join(
        timed, observations(rosters, tracked), {"player_id": "player_id"}, "_at", "at",
        {"roster_at": "at", **{f"roster_{c}": c for c in tracked}},
    )
    return found.drop("_at")
