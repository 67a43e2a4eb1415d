"""Contracts of tables that change part by part: only changed parts are read again.

For each part (a source file or a season) two kinds of state are kept: the violations of every row check, which are
added up, and how often each key occurs, for every set of columns that a contract looks at as a key. Keys are a
few narrow columns of a wide table, combined before they are stored; uniqueness, relationships and parents are decided on
the keys of all parts. The results are those of `check_model` on the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridmart.operators import without_parent
from gridmart.quality.checks import accepted_values, not_null, rule
from gridmart.quality.contracts import CONTRACTS
from gridmart.session import stored
from gridmart.sinks import versions
from gridmart.sinks.versions import KEY

ROWS, PRINTS = "row_checks", "_parts"


def key_sets(model: str) -> list[tuple[str, ...]]:
    """Columns of ``model`` that are keys to its own contract, or that others refer to."""
    own = CONTRACTS[model]
    found = [(c,) for c in own.unique] + [(c,) for c, _, _ in own.relationships]
    if own.grain:
        found.append(tuple(own.grain))
    for contract in CONTRACTS.values():
        found += [(field,) for _, parent, field in contract.relationships if parent == model]
        if contract.parent == model:
            found.append(tuple(contract.grain))
    return list(dict.fromkeys(found))


def row_checks(model: str) -> dict:
    contract = CONTRACTS[model]
    checks = {f"not_null:{c}": not_null(c) for c in contract.not_null}
    checks |= {f"accepted_values:{c}": accepted_values(c, v) for c, v in contract.accepted.items()}
    return checks | {f"rule:{name}": rule(make()) for name, make in contract.rules.items()}


class IncrementalChecks:
    """States of all contracts under ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, model: str, name: str) -> str:
        return f"{self.folder}/{model}/{name}"

    def _keys_name(self, columns: tuple[str, ...]) -> str:
        return "keys-" + "+".join(columns)

    def update(self, model: str, prints: dict[str, str], load: Callable[[list[str]], DataFrame]) -> list[str]:
        """Bring the states of ``model`` up to the parts of ``prints`` (part to fingerprint).

        ``load`` gives the rows of some parts with the part in ``source_file``; it is called once, with the parts that are
        new or changed, which are returned. Parts that are gone leave the states. Fingerprints are written last.
        """
        mark = self._path(model, PRINTS)
        now = versions.current(self.spark, mark)
        before = {k: v["print"] for k, v in now.files.items()} if now else {}
        changed = sorted(k for k, p in prints.items() if before.get(k) != p)
        gone = sorted(before.keys() - prints.keys())
        names = [ROWS, *map(self._keys_name, key_sets(model))]
        if changed:
            checks = row_checks(model)
            columns = list(dict.fromkeys(c for s in key_sets(model) for c in s))
            rows = load(changed).select(
                KEY, *columns, *[check.alias(f"_check_{i}") for i, check in enumerate(checks.values())]
            )
            rows = stored(rows, f"changed-{model}")
            counts = rows.groupBy(KEY).agg(
                F.array(
                    *[
                        F.struct(F.lit(name).alias("check_name"), F.count_if(f"_check_{i}").alias("violations"))
                        for i, name in enumerate(checks)
                    ]
                ).alias("counts")
            )
            parts = {ROWS: counts.select(F.inline("counts"), KEY)}
            for columns in key_sets(model):
                counted = rows.groupBy(KEY, *columns).agg(F.count(F.lit(1)).alias("row_count"))
                parts[self._keys_name(columns)] = counted
            for name, df in parts.items():
                versions.replace(df, self._path(model, name), changed)
        for name in names if gone else ():
            versions.remove(self.spark, self._path(model, name), gone)
        if changed or gone:
            known = {k: {"load": "", "print": p} for k, p in prints.items()}
            versions.commit(self.spark, mark, lambda files: known)
        return changed

    def _keys(self, model: str, columns: tuple[str, ...]) -> DataFrame:
        """How often each key occurs in all parts."""
        states = versions.read(self.spark, self._path(model, self._keys_name(columns)))
        return states.groupBy(*columns).agg(F.sum("row_count").alias("row_count"))

    def _one(self, found: DataFrame, check: str, model: str, count) -> DataFrame:
        return found.agg(F.coalesce(count, F.lit(0)).cast("bigint").alias("violations")).select(
            F.lit(check).alias("check_name"), F.lit(model).alias("model"), "violations"
        )

    def results(self, model: str) -> DataFrame:
        """``(check_name, model, violations)`` as `check_model` gives them; parents must be up to date too."""
        contract = CONTRACTS[model]
        names = self.spark.createDataFrame([(n,) for n in row_checks(model)], "check_name string")
        counted = versions.read(self.spark, self._path(model, ROWS)).groupBy("check_name").agg(
            F.sum("violations").alias("n")
        )
        found = [
            names.join(F.broadcast(counted), "check_name", "left").select(
                "check_name", F.lit(model).alias("model"), F.coalesce("n", F.lit(0)).alias("violations")
            )
        ]
        for column in contract.unique:
            repeated = self._keys(model, (column,)).dropna(subset=[column]).filter("row_count > 1")
            found.append(self._one(repeated, f"unique:{column}", model, F.count(F.lit(1))))
        if contract.grain:
            repeated = self._keys(model, tuple(contract.grain)).filter("row_count > 1")
            found.append(self._one(repeated, "unique:" + "+".join(contract.grain), model, F.count(F.lit(1))))
        for column, parent, field in contract.relationships:
            lost = without_parent(self._keys(model, (column,)), self._keys(parent, (field,)), {column: field})
            found.append(self._one(lost, f"relationships:{column}", model, F.sum("row_count")))
        if contract.parent:
            grain = tuple(contract.grain)
            lost = without_parent(self._keys(model, grain), self._keys(contract.parent, grain), list(grain))
            found.append(self._one(lost, f"parent:{contract.parent}", model, F.sum("row_count")))
        return reduce(DataFrame.unionByName, found)

    def all_results(self, models: list[str] | None = None) -> DataFrame:
        return reduce(DataFrame.unionByName, [self.results(m) for m in (models or list(CONTRACTS))])
