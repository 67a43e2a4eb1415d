"""Spelling variants against plain Python."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmart.llm import fm_index, spelling


def one_error(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


@pytest.mark.parametrize("letters, longest, step", [("ab", 7, 8000), ("abé", 5, 7), ("aÿcdefghij", 9, 8000)])
def test_index_finds_all_words_with_one_error(letters, longest, step, monkeypatch):
    monkeypatch.setattr(fm_index, "STEP", step)
    rng = random.Random(longest)
    for _ in range(8):
        made = {"".join(rng.choice(letters) for _ in range(rng.randrange(1, longest))) for _ in range(80)}
        words = rng.sample(sorted(made), len(made))
        asked = [*words[::2], "zz", letters[0] * 30, *(w + "z" for w in words[:5])]
        a, b = fm_index.Index(words).near(asked)
        found = [(asked[i], words[j]) for i, j in zip(a, b)]
        assert len(found) == len(set(found))
        assert set(found) == {(x, y) for x in asked for y in words if one_error(x, y)}


def test_suffixes_are_sorted():
    for text in ("", "a", "banana", "aaaaaaaa", "abab" * 20):
        codes = np.append(np.frombuffer(text.encode(), dtype=np.uint8).astype(np.int64), 0)
        shown = [bytes(codes[i:].astype(np.uint8)) for i in range(len(codes))]
        assert [shown[i] for i in fm_index.sorted_suffixes(codes)] == sorted(shown)


def test_nothing_to_search():
    assert [len(x) for x in fm_index.Index(["word"]).near([])] == [0, 0]
    assert [len(x) for x in fm_index.Index([]).near(["word"])] == [0, 0]


def vocabulary(rows):
    counts = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ":
                run += c.lower() if c < "À" else c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if h % 199 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                counts[run] += 1
            run = ""
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def expected(words):
    result = {}
    forms = {}
    for w, n in words.items():
        near = [v for v in words if one_error(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 5 * n else None
        result[w] = len(near)

    def root(w):
        return w if forms[w] is None else root(forms[w])

    return {(w, forms[w], root(w), n, result[w], words.get(forms[w])) for w, n in words.items()}


def found(docs, spark):
    counted = spelling.count_words(docs, change=spelling.typo)
    return {tuple(r) for r in spelling.variants(counted).collect()}


def test_awkward_texts(spark, docs, rows):
    own = [(i, t) for i, t in rows]
    assert found(docs, spark) == expected(vocabulary(own))


def variants_of(rng, base, n):
    for _ in range(n):
        w, i = base, rng.randrange(len(base))
        for _ in range(rng.randrange(3)):
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("aeiéÿ") + w[i:], w[:i] + rng.choice("aeié") + w[i + 1 :]])
        yield w


@pytest.fixture(scope="module")
def misspelt():
    rng = random.Random(11)
    rows = []
    for k, base in enumerate(["grammar", "Überall", "élégance", "spelling", "aaaaaaaa", "Formation", "formations"]):
        words = list(variants_of(rng, base, 150)) + [base] * 400 + [base[:-1] + "x"] * 30 + [base[:-2] + "yx"] * 6
        rows += [(len(rows) * 7 + i, " ".join(words[i::5]) + "1" + "q" * 5_000) for i in range(5)]
        rows.append((k, "-".join(rng.sample(words, len(words)))))
    return [*rows, (None, "grammar grammar"), (3, None), (4, ""), (5, "short word")]


@pytest.mark.parametrize("crowd, shard", [(spelling.CROWD, spelling.SHARD), (3, 20)])
def test_chains_and_crowded_halves(spark, misspelt, crowd, shard, monkeypatch):
    monkeypatch.setattr(spelling, "CROWD", crowd)
    monkeypatch.setattr(spelling, "SHARD", shard)
    df = spark.createDataFrame(misspelt, "doc_id bigint, text string").withColumns(
        {"word": F.lit("clash"), "n": F.lit(1), "`a.b`": F.lit(2)}
    )
    got = found(df.repartition(3), spark)
    assert got == expected(vocabulary(misspelt))
    # A chain of two steps and a long word are among them.
    assert any(form not in (None, root) for _, form, root, *_ in got) and any(len(w) >= 5_000 for w, *_ in got)


def test_no_words(spark, no_docs):
    assert found(no_docs, spark) == set()


def test_counts_leave_a_task_before_they_grow(spark, misspelt, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 3)
    df = spark.createDataFrame(misspelt, "doc_id bigint, text string")
    got = {r.word: r.n for r in spelling.count_words(df, change=spelling.typo).collect()}
    assert got == vocabulary(misspelt)
