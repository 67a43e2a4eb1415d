"""As-of join: the last state known at each moment, per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridmart.operators.scan import ROWS, SLICES, numbered, position, quoted, running


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    on: dict[str, str],
    left_time: str,
    right_time: str,
    carry: dict[str, str],
    tiebreak: list[str] = (),
    strict: bool = False,
    forward: bool = False,
    max_gap: float | None = None,
    rows: int = ROWS,
    slices: int = SLICES,
) -> DataFrame:
    """Every row of ``left``, with columns of the last row of ``right`` at or before its time.

    ``on`` maps key columns of ``left`` to those of ``right``, ``carry`` new names to columns of ``right``. ``strict``
    leaves out equal times, ``forward`` takes the first row at or after. Of rows of ``right`` at one time the greatest
    by ``tiebreak`` (then by the carried columns) counts. Matches further away than ``max_gap`` (days for dates, microseconds for
    timestamps, else units of the number) are none.

    Both sides are merged into one ordered series per key, along which the last state is carried (`running`): one
    shuffle, no join of rows with rows, and a key with very many rows is cut into slices of time that take
    over the state of those before. Rows with a NULL key or time match nothing; they do not enter the merge.
    """
    n = len(on)
    own = numbered(list(on), "_j")
    sign = F.lit(-1 if forward else 1)
    at_left, at_right = position(left, left_time) * sign, position(right, right_time) * sign
    # At equal times states come first, unless only earlier ones count.
    late, early = F.lit(1 if strict else 0), F.lit(0 if strict else 1)
    state = F.struct(
        at_right.alias("at"), *[quoted(c).alias(f"c{i}") for i, c in enumerate(carry.values())]
    )
    ties = F.struct(*[quoted(c).alias(f"t{i}") for i, c in enumerate(tiebreak)], state.alias("s"))
    right_rows = right.select(
        *numbered(list(on.values()), "_j"), at_right.alias("_time"), late.alias("_kind"),
        ties.alias("_tie"), state.alias("_state"),
    )
    known = ["_time", *[f"_j{i}" for i in range(n)]]
    left_rows = left.select(
        *own, at_left.alias("_time"), early.alias("_kind"), F.struct(*[quoted(c).alias(f"l{i}") for i, c in enumerate(left.columns)]).alias("_row")
    )
    merged = (
        left_rows.dropna(subset=known)
        .unionByName(right_rows.dropna(subset=known), allowMissingColumns=True)
    )
    carried = running(
        merged, [f"_j{i}" for i in range(n)], ["_time", "_kind", "_tie"], {"_last": ("last", "_state")}, rows, slices
    ).filter(F.col("_row").isNotNull())
    near = F.col("_last").isNotNull()
    if max_gap is not None:
        near = near & (F.col("_time") - F.col("_last.at") <= max_gap)
    rest = left_rows.filter(" OR ".join(f"{c} IS NULL" for c in known)).withColumn(
        "_last", F.lit(None).cast(carried.schema["_last"].dataType)
    )
    whole = carried.select("_row", "_time", "_last").unionByName(rest.select("_row", "_time", "_last"))
    return whole.select(
        *[F.col(f"_row.l{i}").alias(c) for i, c in enumerate(left.columns)],
        *[F.when(near, F.col(f"_last.c{i}")).alias(name) for i, name in enumerate(carry)],
    )
