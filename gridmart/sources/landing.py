"""What has landed, what is missing, and reading it with provenance."""

from __future__ import annotations

import json
import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql import types as T

from gridmart.operators.codes import small_side

#: Footers read at a time, and manifest entries that may be broadcast.
FOOTERS = 16
FILES = 100_000

PROVENANCE = "source_file source_dataset source_year loaded_at".split()


def list_landed(spark: SparkSession, root: str, changed: bool = False) -> DataFrame:
    """Keys of the Parquet files under ``root``; only names, sizes and times are read."""
    base = root.rstrip("/") + "/"
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(base)
        .select("path", "length", "modificationTime")
    )
    # The root is taken literally: no character of it has a special meaning.
    prefix = F.lit(base.split(":", 1)[-1])
    at = F.instr(F.col("path"), prefix)
    inside = F.when(at > 0, F.substring(F.col("path"), at + F.length(prefix), F.length("path"))).otherwise(
        F.raise_error(F.concat(F.lit(f"not below {base}: "), F.col("path")))
    )
    # A dataset file may itself be a folder of part files: its key ends at the first ".parquet".
    key = F.regexp_extract(inside, r"^(.*?\.parquet)", 1)
    more = [F.count(F.lit(1)).alias("parts"), F.unix_micros(F.max("modificationTime")).alias("changed")]
    return files.groupBy(key.alias("source_key")).agg(F.sum("length").alias("bytes"), *more[: 2 * changed])


def landing_status(
    manifest: DataFrame, landed: DataFrame, failures: DataFrame | None = None
) -> DataFrame:
    """Manifest plus ``status``: every file is exactly one of failed, uploaded, missing.

    ``failures`` holds the ``source_key`` values whose transfer went wrong.
    """
    seen = landed.select("source_key").distinct().withColumn("_seen", F.lit(True))
    found = manifest.join(seen, "source_key", "left")
    if failures is None:
        bad = F.lit(False)
    else:
        wrong = failures.select("source_key").distinct().withColumn("_bad", F.lit(True))
        found = found.join(wrong, "source_key", "left")
        bad = F.col("_bad").isNotNull()
    status = (
        F.when(bad, "failed").when(F.col("_seen").isNotNull(), "uploaded").otherwise("missing")
    )
    return found.withColumn("status", status).select(*manifest.columns, "status")


def landing_counts(status: DataFrame) -> DataFrame:
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("files"))


def require_no_failures(status: DataFrame) -> dict[str, int]:
    """Counts by status; raises if any file failed, so that nothing is loaded then."""
    counts = dict.fromkeys(("uploaded", "missing", "failed"), 0)
    counts.update({row["status"]: row["files"] for row in landing_counts(status).collect()})
    if counts["failed"]:
        raise RuntimeError(f"landing failed for {counts['failed']} file(s)")
    return counts


def fingerprints(spark: SparkSession, root: str) -> dict[str, str]:
    """Size, number of parts and time of the last change of every landed file, as one string by key.

    From the listing alone: a few dozen bytes per file on the driver, as for the manifest.
    """
    found = list_landed(spark, root, changed=True).collect()
    return {r["source_key"]: f"{r['bytes']}-{r['parts']}-{r['changed']}" for r in found}


def _footers(spark: SparkSession):
    """A function that gives the file schema in the footer of a Parquet file, as text, and Spark's own schema
    if Spark wrote one. Classes are looked up once, not per file."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path_of = jvm.org.apache.hadoop.fs.Path
    input_of = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromStatus
    opened = jvm.org.apache.parquet.hadoop.ParquetFileReader.open

    def footer(path: str) -> tuple[str, str | None]:
        at = path_of(path)
        store = at.getFileSystem(conf)
        status = store.getFileStatus(at)
        if status.isDirectory():  # its first part
            parts = {s.getPath().getName(): s for s in store.listStatus(at)}
            status = parts[min(name for name in parts if name.endswith(".parquet"))]
        reader = opened(input_of(status, conf))
        try:
            meta = reader.getFileMetaData()
            own = meta.getKeyValueMetaData().get("org.apache.spark.sql.parquet.row.metadata")
            return meta.getSchema().toString(), own
        finally:
            reader.close()

    return footer


def schema_classes(spark: SparkSession, root: str, keys: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """Files with the same schema together: ``(schema, keys)`` for each that occurs.

    Footers are read a few at a time; between years there are a handful of schemas, however many files.
    """
    base, footer = root.rstrip("/"), _footers(spark)
    with ThreadPoolExecutor(FOOTERS) as pool:
        footers = list(pool.map(lambda key: footer(f"{base}/{key}"), keys))
    classes: dict[tuple[str, str | None], list[str]] = {}
    for key, found in zip(keys, footers, strict=True):
        classes.setdefault(found, []).append(key)
    return [
        (T.StructType.fromJson(json.loads(own)) if own else spark.read.parquet(f"{base}/{files[0]}").schema, files)
        for (_, own), files in classes.items()
    ]


def _shown(path: Column) -> Column:
    """A path without its scheme, and with the characters that a URI escapes."""
    plain = F.regexp_replace(path, "^[a-zA-Z][a-zA-Z0-9+.-]*:/+", "/")
    return F.url_decode(F.replace(plain, F.lit("+"), F.lit("%2B")))


def scan_with_provenance(
    spark: SparkSession,
    root: str,
    entries: list[Row],
    classes: list[tuple[T.StructType, list[str]]] | None = None,
) -> DataFrame:
    """All given files of one raw table as ``record`` (variant) plus the provenance columns.

    The schema may drift between years: each file keeps its own fields inside ``record``. Files of one schema are one
    scan; a row finds its manifest entry by the path that was really read. Reloads delete by key, so a
    file that belongs to no entry is an error.
    """
    base = root.rstrip("/")
    by_key = {e["source_key"]: e for e in entries}
    known = spark.createDataFrame(
        [(k, e["dataset"], e["year"]) for k, e in by_key.items()],
        "source_file string, source_dataset string, source_year int",
    )
    # One row for each file of the manifest.
    known = small_side(known, FILES)
    prefix = "/" + re.sub("^([a-zA-Z][a-zA-Z0-9+.-]*:)?/*", "", base) + "/"
    scans = []
    for schema, keys in classes or schema_classes(spark, root, list(by_key)):
        data = spark.read.schema(schema).parquet(*[f"{base}/{key}" for key in keys])
        path = _shown(F.col("_metadata.file_path"))
        at = F.instr(path, F.lit(prefix))
        # A dataset file may itself be a folder of part files: its key ends at the first ".parquet".
        key = F.regexp_extract(F.substring(path, at + len(prefix), F.length(path)), r"^(.*?\.parquet)", 1)
        scans.append(
            data.select(
                F.to_variant_object(F.struct(*[F.col(f"`{c}`") for c in data.columns])).alias("record"),
                key.alias("_key"),
                path.alias("_path"),
            )
        )
    found = reduce(DataFrame.unionByName, scans).join(known, F.col("_key") == F.col("source_file"), "left")
    wrong = F.raise_error(F.concat(F.lit("of no file in the manifest: "), F.col("_path")))
    return found.select(
        "record",
        F.when(F.col("source_file").isNotNull(), F.col("source_file")).otherwise(wrong).alias("source_file"),
        "source_dataset",
        "source_year",
        F.current_timestamp().alias("loaded_at"),
    )
