"""Overlap join of intervals, without comparing all rows of a key.

An interval's level is the power of two (in steps of ``STEP``) that is at least its length; bins of a level are as long as that,
so an interval lies in two of them at most. A pair meets on the level of its longer interval, where the shorter one
is a guest: it is posted on each level above its own that the other side really has. Bins there are at most ``2 ** STEP``
times as long as the intervals they are compared with, so most rows that meet do overlap. A pair that
shares two bins is told in the one that its overlap begins in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gridmart.operators.codes import small_side
from gridmart.operators.scan import numbered, position, quoted

STEP = 2
#: Intervals of one level in a bin that one task compares with the bin's others.
CROWD = 10_000
LISTED = 200_000


def _whole(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.typeName()
    if kind in ("float", "double", "decimal"):
        raise TypeError(f"{column} ({kind}): bounds are whole numbers, dates or timestamps")
    return position(df, column).cast("bigint")


def _bounded(df: DataFrame, keys: list[str], start: str, end: str, name: str) -> DataFrame:
    """``_k…, _start, _end, _level, _row``; empty intervals and those without a bound or a key are left out."""
    rows = df.select(
        *numbered(keys, "_k"),
        _whole(df, start).alias("_start"),
        _whole(df, end).alias("_end"),
        F.struct(*[quoted(c).alias(f"c{i}") for i, c in enumerate(df.columns)]).alias(f"_{name}"),
    )
    rows = rows.dropna(subset=[f"_k{i}" for i in range(len(keys))] + ["_start", "_end"]).filter("_start < _end")
    # Binary digits of the length less one; the step above.
    digits = F.expr("IF(_end - _start = 1, 0, length(bin(_end - _start - 1)))")
    return rows.withColumn("_level", (F.ceil(digits / STEP) * STEP).cast("int"))


def _in_bins(rows: DataFrame) -> DataFrame:
    """A row for each of the (one or two) bins of ``_on`` that an interval lies in."""
    return rows.withColumn("_bin", F.explode(F.expr("sequence(shiftright(_start, _on), shiftright(_end - 1, _on))")))


def _posted(rows: DataFrame, levels: list[int]) -> tuple[DataFrame, DataFrame]:
    """A side on its own level, and as a guest on higher levels of the other side."""
    own = _in_bins(rows.withColumn("_on", F.col("_level")))
    above = F.filter(F.array(*[F.lit(x) for x in levels]), lambda x: x > F.col("_level"))
    return own, _in_bins(rows.withColumn("_on", F.explode(above)))


def _met(hosts: DataFrame, others: DataFrame, keys: int, host: str, other: str) -> DataFrame:
    """Pairs in the same bin that overlap and whose overlap begins there. Crowded bins are dealt out."""
    place = [*[f"_k{i}" for i in range(keys)], "_on", "_bin"]
    crowded = hosts.groupBy(*place).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > CROWD)
    crowded = small_side(crowded.select(*place, F.ceil(F.col("_n") / CROWD).cast("int").alias("_parts")), LISTED)
    parts = F.coalesce("_parts", F.lit(1))
    deal = F.pmod(F.xxhash64("_start", "_end", f"_{host}"), parts).cast("int")
    a = hosts.join(crowded, place, "left").select(
        *place, deal.alias("_part"), F.col("_start").alias("_s"), F.col("_end").alias("_e"), f"_{host}"
    )
    b = others.join(crowded, place, "left").select(
        *place, F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"), "_start", "_end", f"_{other}"
    )
    begins = F.expr("shiftright(greatest(_s, _start), _on)")
    return (
        a.join(b, [*place, "_part"])
        .filter("_s < _end AND _start < _e")
        .filter(begins == F.col("_bin"))
        .select(
            f"_{host}", f"_{other}", F.greatest("_s", "_start").alias("_from"), F.least("_e", "_end").alias("_to")
        )
    )


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    on: dict[str, str],
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    select: dict[str, str],
) -> DataFrame:
    """Pairs of rows with equal keys whose intervals [start, end) overlap, each pair once.

    ``on`` maps key columns of ``left`` to those of ``right`` (it may be empty). Bounds are whole numbers, dates or
    timestamps. ``select`` maps new names to ``left.column``, ``right.column``, or to ``start`` and ``end``, which are the bounds of
    the overlap (whole numbers, days or microseconds). Intervals that are empty or lack a bound or a key overlap with
    nothing. The driver sees the levels of both sides, 64 numbers at most.
    """
    for column in {*left_span, *right_span}:
        if column not in (*left.columns, *right.columns):
            raise ValueError(f"no column {column}")
    n = len(on)
    a = _bounded(left, list(on), *left_span, "left")
    b = _bounded(right, list(on.values()), *right_span, "right")
    levels = [sorted(r[0] for r in side.select("_level").distinct().collect()) for side in (a, b)]
    a_own, a_guest = _posted(a, levels[1])
    b_own, b_guest = _posted(b, levels[0])
    met = [
        # The left interval is the longer one, or as long; then the right one is.
        _met(a_own, b_own.unionByName(b_guest), n, "left", "right"),
        _met(b_own, a_guest, n, "right", "left"),
    ]
    pairs = met[0].unionByName(met[1])
    places = {f"left.{c}": f"_left.c{i}" for i, c in enumerate(left.columns)}
    places |= {f"right.{c}": f"_right.c{i}" for i, c in enumerate(right.columns)}
    places |= {"start": "_from", "end": "_to"}
    return pairs.select(*[F.col(places[source]).alias(name) for name, source in select.items()])
