"""Run contracts over the tables of a warehouse."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from gridmart.quality.checks import (
    accepted_values,
    count_violations,
    duplicate_keys,
    not_null,
    orphans,
    rule,
)
from gridmart.quality.contracts import CONTRACTS
from gridmart.session import stored


def _counted(found: DataFrame, check: str, model: str, count) -> DataFrame:
    return found.agg(F.coalesce(count, F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(check).alias("check_name"), F.lit(model).alias("model"), "violations"
    )


def check_model(tables, model: str) -> DataFrame:
    """``(check_name, model, violations)`` for all checks of ``model``.

    ``tables`` gives frames by name. The columns of the contract and the outcome of its rules are stored
    once; all row checks share one pass over them, each key check is an aggregation of its own.
    """
    contract = CONTRACTS[model]
    rules = {name: rule(make()) for name, make in contract.rules.items()}
    columns = [*contract.not_null, *contract.unique, *contract.accepted, *contract.grain]
    columns += [c for c, _, _ in contract.relationships]
    df = tables(model).select(
        *dict.fromkeys(columns), *[v.alias(f"_rule_{i}") for i, v in enumerate(rules.values())]
    )
    if len(contract.relationships) + len(contract.unique) + bool(contract.grain) > 1:
        # Several checks read what the contract looks at; the model itself is computed once.
        df = stored(df, f"check-{model}")
    rows = {f"not_null:{c}": not_null(c) for c in contract.not_null}
    rows |= {f"accepted_values:{c}": accepted_values(c, v) for c, v in contract.accepted.items()}
    rows |= {f"rule:{name}": F.col(f"_rule_{i}") for i, name in enumerate(rules)}
    results = [count_violations(df, model, rows)]
    for column in contract.unique:
        found = duplicate_keys(df, [column], ignore_null=True)
        results.append(_counted(found, f"unique:{column}", model, F.count(F.lit(1))))
    if contract.grain:
        found = duplicate_keys(df, contract.grain)
        name = "unique:" + "+".join(contract.grain)
        results.append(_counted(found, name, model, F.count(F.lit(1))))
    for column, parent, field in contract.relationships:
        found = orphans(df, tables(parent), {column: field})
        results.append(_counted(found, f"relationships:{column}", model, F.sum("row_count")))
    if contract.parent:
        found = orphans(df, tables(contract.parent), {c: c for c in contract.grain})
        results.append(
            _counted(found, f"parent:{contract.parent}", model, F.sum("row_count"))
        )
    return reduce(DataFrame.unionByName, results)


def run_checks(tables, models: list[str] | None = None) -> DataFrame:
    """All checks of all (or the given) models as one frame."""
    return reduce(
        DataFrame.unionByName, [check_model(tables, m) for m in (models or list(CONTRACTS))]
    )


def failed(results: DataFrame) -> DataFrame:
    return results.filter(F.col("violations") > 0)
