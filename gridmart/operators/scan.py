"""Running values over ordered groups of any size: a scan on two levels.

A window puts a whole group into one task. Here groups with more than ``ROWS`` rows are cut along their order into
slices; a window runs inside each slice, and what all slices before have come to, one row per slice, is
combined with it. That needs operations that combine: sum, count, least, greatest, and the last value known.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridmart.operators.codes import small_side
from gridmart.session import stored

#: Groups up to this size stay whole.
ROWS = 1_000_000
SLICES = 64
#: Crowded groups (with SLICES numbers each) whose limits may be broadcast.
LISTED = 5_000

_PLAIN = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
OPERATIONS = (*_PLAIN, "last")


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def position(df: DataFrame, column: str) -> Column:
    """A number in the order of a number, a date or a timestamp."""
    kind, found = df.schema[column].dataType.typeName(), quoted(column)
    if kind == "date":
        return F.unix_date(found).cast("bigint")
    if kind == "timestamp":
        return F.unix_micros(found)
    if kind == "timestamp_ntz":
        return F.unix_micros(F.to_utc_timestamp(found, "UTC"))
    if kind in ("string", "binary", "array", "map", "struct", "variant", "boolean"):
        raise TypeError(f"{column} ({kind}) has no distances: a number or a time is needed")
    return found


def numbered(keys: list[str], prefix: str) -> list[Column]:
    """The keys under names that no column of the caller has to avoid but by their underscore."""
    return [quoted(k).alias(f"{prefix}{i}") for i, k in enumerate(keys)]


def same_keys(one: list[Column], other: list[Column]) -> Column:
    """Equality in which NULL is a value like others."""
    return reduce(Column.__and__, [a.eqNullSafe(b) for a, b in zip(one, other, strict=True)], F.lit(True))


def slice_groups(
    df: DataFrame, keys: list[str], at: str, rows: int = ROWS, slices: int = SLICES
) -> tuple[DataFrame, bool]:
    """Add ``_slice``, NULL in groups of ``rows`` rows or fewer: rows of a slice come before those of the next.

    ``at`` is a number; equal ones share a slice, NULLs are in the first. Limits come from a sketch of each crowded
    group, of which there can't be more than all rows divided by ``rows``; they are stored, so all uses agree.
    Also returned is whether any group is cut.
    """
    own, names = numbered(keys, "_k"), [F.col(f"_k{i}") for i in range(len(keys))]
    sizes = df.groupBy(*own).agg(F.count(F.lit(1)).alias("_rows"))
    crowded = stored(sizes.filter(F.col("_rows") > rows).drop("_rows"), "crowded-groups")
    if crowded.isEmpty():
        return df.withColumn("_slice", F.lit(None).cast("int")), False
    steps = [i / slices for i in range(1, slices)]
    other = crowded.toDF(*[f"_c{i}" for i in range(len(keys))])
    inside = df.select(*own, F.col(at).alias("_at")).join(
        small_side(other, LISTED), same_keys(names, [F.col(f"_c{i}") for i in range(len(keys))]), "left_semi"
    )
    limits = inside.groupBy(*names).agg(F.percentile_approx("_at", steps, 20 * slices).alias("_limits"))
    # A group whose order is NULL throughout has no limits, but is one slice.
    limits = limits.withColumn("_limits", F.coalesce("_limits", F.array().cast(limits.schema["_limits"].dataType)))
    limits = small_side(stored(limits, "slice-limits"), LISTED)
    joined = df.join(limits, same_keys([quoted(k) for k in keys], names), "left")
    below = F.size(F.filter("_limits", lambda x: x < F.col(at)))
    cut = joined.withColumn("_slice", F.when(F.col("_limits").isNotNull(), below))
    return cut.drop("_limits", *[f"_k{i}" for i in range(len(keys))]), True


def _windowed(operation: str, column: Column, frame) -> Column:
    if operation == "last":
        return F.last(column, ignorenulls=True).over(frame)
    return _PLAIN[operation](column).over(frame)


def _combined(operation: str, before: Column, own: Column) -> Column:
    if operation == "sum":
        return F.coalesce(before + own, before, own)
    if operation == "count":
        return F.coalesce(before, F.lit(0)) + own
    if operation in ("min", "max"):
        return (F.least if operation == "min" else F.greatest)(before, own)
    return F.coalesce(own, before)


def _carried(cut: DataFrame, keys: list[str], order: list[str], values: list[tuple[str, str]]) -> DataFrame:
    """For each slice of a crowded group what the slices before it come to: ``_k…, _s, _b…``."""
    place = F.struct(
        *[part for i, c in enumerate(order) for part in (quoted(c).isNotNull().alias(f"n{i}"), quoted(c).alias(f"o{i}"))]
    )
    own = []
    for i, (operation, column) in enumerate(values):
        value = quoted(column)
        if operation == "last":
            own.append(F.max_by(value, F.when(value.isNotNull(), place)).alias(f"_t{i}"))
        else:
            own.append(_PLAIN[operation](value).alias(f"_t{i}"))
    inside = cut.filter(F.col("_slice").isNotNull())
    totals = inside.groupBy(*numbered(keys, "_k"), F.col("_slice").alias("_s")).agg(*own)
    names = [f"_k{i}" for i in range(len(keys))]
    before = Window.partitionBy(*names).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    sums = [
        # Counts of slices are added up.
        _windowed("sum" if operation == "count" else operation, F.col(f"_t{i}"), before).alias(f"_b{i}")
        for i, (operation, _) in enumerate(values)
    ]
    return totals.select(*names, "_s", *sums)


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    values: dict[str, tuple[str, str]],
    rows: int = ROWS,
    slices: int = SLICES,
) -> DataFrame:
    """``df`` with a running value per row: ``values`` maps a new name to (operation, column).

    Values run from a group's first row to the row itself, in the order of ``order`` (ascending, NULLs first), whose
    first column is a number, a date or a timestamp; the columns together should make the order total. NULL keys are a group. Sums skip
    NULLs and are NULL until there is a value; ``last`` is the last value that is not NULL.
    """
    wanted = list(values.values())
    unknown = {operation for operation, _ in wanted} - set(OPERATIONS)
    if unknown:
        raise ValueError(f"unknown operations {sorted(unknown)}; expected some of {OPERATIONS}")
    kept = [quoted(c) for c in df.columns]
    cut, crowded = slice_groups(df.withColumn("_at", position(df, order[0])), keys, "_at", rows, slices)
    frame = (
        Window.partitionBy(*[quoted(k) for k in keys], "_slice")
        .orderBy(*[F.asc_nulls_first(quoted(c)) for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    own = [_windowed(operation, quoted(c), frame).alias(f"_v{i}") for i, (operation, c) in enumerate(wanted)]
    local = cut.select(*kept, "_slice", *own)
    if not crowded:
        return local.select(*kept, *[F.col(f"_v{i}").alias(name) for i, name in enumerate(values)])
    carried = small_side(_carried(cut, keys, order, wanted), LISTED * slices)
    names = [F.col(f"_k{i}") for i in range(len(keys))]
    joined = local.join(
        carried, same_keys([quoted(k) for k in keys], names) & (F.col("_slice") == F.col("_s")), "left"
    )
    results = [
        _combined(operation, F.col(f"_b{i}"), F.col(f"_v{i}")).alias(name)
        for i, (name, (operation, _)) in enumerate(values.items())
    ]
    return joined.select(*kept, *results)
