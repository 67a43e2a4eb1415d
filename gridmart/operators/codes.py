"""Attach a conformed dimension to code columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


# Far more rows than a code dimension has, far fewer than a broadcast can carry.
SMALL_ROWS = 10_000


def small_side(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``max_rows`` rows, else as it is.

    The rows are counted (stopping after the bound), as the optimizer's estimate for a joined or
    grouped dimension can be far off, and shuffling all plays by a few dozen team
    codes is what must not happen.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def normalize_codes(
    df: DataFrame,
    codes: DataFrame,
    code_column: str,
    prefix: str,
    how: str = "left",
    keep: tuple[str, ...] = ("franchise_id",),
) -> DataFrame:
    """Add ``{prefix}_{c}`` for each ``c`` in ``keep``, found by ``code_column``.

    ``left`` keeps rows whose code is unknown or NULL with NULL attributes,
    ``inner`` drops them. ``codes`` is unique on ``source_team_code``; pass it through
    ``small_side``. Beyond that bound it is a shuffle join whose hot codes AQE splits.
    """
    role = codes.select(
        F.col("source_team_code").alias(f"_{prefix}_code"),
        *[F.col(c).alias(f"{prefix}_{c}") for c in keep],
    )
    return df.join(role, F.col(code_column) == F.col(f"_{prefix}_code"), how).drop(
        f"_{prefix}_code"
    )
