"""A training corpus from ``documents``: each stage works on all that the stage before has kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridmart.llm import decontaminate, langid, near_duplicates, packing, substrings
from gridmart.llm.queries import prepare
from gridmart.llm.tables import documents, read_table
from gridmart.session import discard, new_work_path, work_paths


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language compression tells; those it rejects go."""
    prepare(spark)
    return langid.accepted(docs)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates."""
    prepare(spark)
    return near_duplicates.one_of_each(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the passages of 50 words or more that an earlier one has."""
    prepare(spark)
    return substrings.shortened(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of ten words of a benchmark item occurs."""
    prepare(spark)
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of what is left, with its place in sequences of 2048 tokens."""
    prepare(spark)
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", language),
    ("copies", copies),
    ("passages", passages),
    ("leaks", leaks),
    ("sequences", sequences),
]

#: zstandard and tokenizers are not at hand in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. When a stage's output is written, what only led to it, and the output before, are deleted."""
    docs, before = documents(spark, sf_dir), []
    for name, stage in STAGES[:-1]:
        others = work_paths(spark)
        path = new_work_path(spark, f"stage-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.option("compression", "zstd").parquet(path)
        made = [p for p in work_paths(spark) if p not in others and p != path]
        docs = spark.read.schema(out.schema).parquet(path)
        discard(spark, made + before)
        before = [path]
    return STAGES[-1][1](spark, docs, sf_dir)
