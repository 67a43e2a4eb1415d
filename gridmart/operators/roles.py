"""One row per play and player role."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def unpivot_roles(
    df: DataFrame, roles: dict[str, str], carry: list[str], id_name: str = "player_id"
) -> DataFrame:
    """``carry`` plus ``id_name`` and one 0/1 ``is_{role}`` column per role.

    ``roles`` maps a role to its id column; empty roles give no row. The table is read
    once, however many roles there are.
    """
    some = F.coalesce(*[F.col(c) for c in roles.values()]).isNotNull()
    by_column = {column: role for role, column in roles.items()}
    long = df.filter(some).unpivot(carry, list(by_column), "_column", id_name)
    return long.filter(F.col(id_name).isNotNull()).select(
        *carry,
        id_name,
        *[
            (F.col("_column") == column).cast("int").alias(f"is_{role}")
            for column, role in by_column.items()
        ],
    )
