"""Raw tables: a reload of a source file replaces exactly that file's rows."""

from __future__ import annotations

import json
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from gridmart.sinks import versions
from gridmart.sources.landing import fingerprints, scan_with_provenance, schema_classes


SCHEMA = (
    "record variant, source_dataset string, source_year int, "
    "loaded_at timestamp, source_file string"
)


def replace_by_source_file(
    df: DataFrame, path: str, files: list[str], known: dict[str, dict] | None = None
) -> None:
    """Replace the rows of ``files`` in the raw table at ``path`` by ``df``; keep all others.

    Readers see the table before or after, never in between (`versions`). Loading a file twice changes nothing;
    a file that now yields no rows is no longer there. The input is computed once.
    """
    versions.replace(df, path, files, known)


def read_raw(spark: SparkSession, path: str, files: list[str] | None = None) -> DataFrame:
    """The raw table as it is at this moment, or the rows of some source files."""
    return versions.read(spark, path, SCHEMA, files)


def merged_schema(one: T.StructType, other: T.StructType) -> T.StructType:
    """Fields of both. Whole numbers widen to ``bigint``, other pairs of number types to ``double``, any
    other two types to ``string``."""
    kinds = {f.name: f.dataType for f in one.fields}
    for field in other.fields:
        own = kinds.setdefault(field.name, field.dataType)
        if own != field.dataType:
            both = (own, field.dataType)
            if all(isinstance(t, T.IntegralType) for t in both):
                kinds[field.name] = T.LongType()
            elif all(isinstance(t, T.NumericType) for t in both):
                kinds[field.name] = T.DoubleType()
            else:
                kinds[field.name] = T.StringType()
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def _schema_path(out: str, table: str) -> str:
    return f"{out.rstrip('/')}/_schemas/{table}"


def read_schema(spark: SparkSession, out: str, table: str) -> T.StructType | None:
    """Fields of the raw table's records as the loads so far have found them in the files."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_schema_path(out, table))
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return None
    return T.StructType.fromJson(json.loads(spark.read.text(_schema_path(out, table)).first()[0]))


def _keep_schema(spark: SparkSession, out: str, table: str, found: list[T.StructType]) -> None:
    merged = read_schema(spark, out, table) or T.StructType()
    for schema in found:
        merged = merged_schema(merged, schema)
    text = spark.createDataFrame([(merged.json(),)], "value string").coalesce(1)
    text.write.mode("overwrite").text(_schema_path(out, table))


def load_landed(
    spark: SparkSession, status: DataFrame, root: str, out: str, skip_unchanged: bool = False
) -> dict[str, int]:
    """Load every uploaded file of a manifest into its raw table under ``out``.

    One write per raw table; the number of files loaded per table is returned. No
    uploaded files means no work. The first table that fails ends the batch,
    tables already written stay. With ``skip_unchanged`` a file with the fingerprint (size, parts and time
    of change) of its last load is left alone.
    """
    entries = status.filter(F.col("status") == "uploaded").orderBy("source_key").collect()
    tables = defaultdict(list)
    for entry in entries:
        tables[entry["raw_table"]].append(entry)
    prints = fingerprints(spark, root) if entries else {}
    loaded = {}
    for table, rows in tables.items():
        path = f"{out.rstrip('/')}/{table}"
        if skip_unchanged:
            now = versions.current(spark, path)
            before = {k: v.get("print") for k, v in now.files.items()} if now else {}
            rows = [r for r in rows if before.get(r["source_key"]) != prints.get(r["source_key"])]
            if not rows:
                continue
        keys = [row["source_key"] for row in rows]
        classes = schema_classes(spark, root, keys)
        known = {k: {"print": prints[k]} for k in keys if k in prints}
        replace_by_source_file(scan_with_provenance(spark, root, rows, classes), path, keys, known)
        _keep_schema(spark, out, table, [schema for schema, _ in classes])
        loaded[table] = len(rows)
    return loaded
