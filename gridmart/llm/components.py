"""Connected components of a stored edge list, without gathering any component."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridmart.llm.tables import keep


def _rounds(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step: every node moves to smaller neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    large = (
        both.filter("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )
    root = large.groupBy("u").agg(F.min("v").alias("m"))
    return (
        large.join(root, "u")
        .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), "m")
        .withColumnRenamed("m", "v")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``u, v``: every node that has an edge but the smallest of its component, and that smallest one.

    ``edges`` has ids ``u`` and ``v``, no matter which is larger. The alternating star algorithm needs a
    number of rounds logarithmic in the longest path; each round's edges are stored. Hot nodes: minima are
    combined before the shuffle, and joins on a node may be split.
    """
    larger, smaller = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    current = keep(edges.filter("u <> v").select(larger, smaller).distinct(), "edges")
    state = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    before = current.agg(state).first()[0]
    while before[0]:
        current = keep(_rounds(current), "edges")
        now = current.agg(state).first()[0]
        if now == before:
            break
        before = now
    return current
