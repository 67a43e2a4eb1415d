import random

import pytest
from pyspark.sql import types as T

from gridmart.llm import queries

WORDS = [a + b for a in "la te mi so ru da ne".split() for b in "ka lo pi ra mu se no".split()]


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    queries.prepare(spark)


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ".", "\n"]) for _ in range(n))


def awkward_rows() -> list[tuple]:
    """NULLs, empty and very long texts, copies, near copies, shared passages, repeated rows."""
    rng = random.Random(7)
    passage = sentence(rng, 70)
    base = sentence(rng, 200).split(" ")
    rows = [(i, sentence(rng, rng.choice([3, 40, 120, 300]))) for i in range(30)]
    rows += [(40 + i, sentence(rng, 30) + " " + passage + " " + sentence(rng, i)) for i in range(8)]
    for i in range(12):
        near = list(base)
        near[rng.randrange(200)] = "changed"
        rows.append((60 + i, " ".join(near)))
    rows += [(80 + i, " ".join(base)) for i in range(6)]
    rows += [(90, None), (91, ""), (92, " \t\n "), (93, "One"), (94, "one two THREE"), (95, "123 .."), (97, "É ß ñ 日本 \U0001f600")]
    rows += [(98, sentence(rng, 30_000)), (99, "a" * 5000), (96, "  two  spaces \n\n here ")]
    rows += [(5, rows[5][1]), (5, rows[5][1]), (41, "other text of the same id"), (None, passage), (None, None)]
    return rows


SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        # Names that the operators use themselves.
        T.StructField("row", T.StringType()),
        T.StructField("out", T.IntegerType()),
        T.StructField("n_words", T.StringType()),
        T.StructField("result", T.DoubleType()),
        T.StructField("key", T.StringType()),
        T.StructField("bucket", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("length", T.StringType()),
    ]
)


def frame(spark, rows):
    full = [(*r, "en" if i % 3 else None, "r", i, "x", 0.5, None, "b", "z", "l") for i, r in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="session")
def rows():
    return awkward_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows).repartition(3).cache()


@pytest.fixture(scope="session")
def unique_rows(rows):
    """Rows with an id of their own each."""
    found = {}
    for i, text in rows:
        if i is not None:
            found.setdefault(i, text)
    return sorted(found.items())


@pytest.fixture(scope="session")
def unique_docs(spark, unique_rows):
    return frame(spark, unique_rows).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, [])
