"""Substring removal, near duplicates and fingerprints against brute force."""

import hashlib
import random
import time
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmart import session
from gridmart.llm import near_duplicates, simhash, substrings
from gridmart.llm.components import components
from gridmart.llm.tables import keep_alone


def removed(rows, window):
    starts = defaultdict(list)
    for i, text in rows:
        words = (text or "").encode().split()
        for k in range(len(words) - window + 1 if i is not None else 0):
            starts[tuple(words[k : k + window])].append(i)
    found = []
    for i, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for k in range(len(words) - window + 1 if i is not None else 0):
            if min(starts[tuple(words[k : k + window])]) < i:
                gone.update(range(k, k + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        found.append((i, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=str)


@pytest.mark.parametrize("window", [50, 7])
def test_substrings_equal_brute_force(docs, rows, window):
    got = substrings.digest(substrings.remove_repeats(docs, window)).collect()
    assert sorted(map(tuple, got), key=str) == removed(rows, window)


def test_shortened_documents_keep_their_columns(docs, rows):
    new = substrings.shortened(docs)
    assert new.schema.names == docs.schema.names
    changed = {(r.doc_id, r.out): r.text for r in new.collect()}
    for at, (i, text) in enumerate(rows):
        kept = changed[i, at]
        if i is not None and 41 <= i < 48 and text.count(" ") > 80:
            assert len(kept.split()) < len(text.split()) - 60
        elif i is not None and i < 30:
            assert kept == text


@pytest.mark.parametrize("window, letters", [(3, 2), (10, 2), (10, 3), (15, 2), (24, 2)])
def test_repetitive_texts_equal_brute_force(spark, window, letters):
    """Few different words: anchors with ties, blocks that overlap, contents that differ by a word."""
    rng = random.Random(window * letters)
    base = [rng.choice("abc"[:letters]) for _ in range(400)]
    rows = []
    for i in range(30):
        words = [rng.choice("abc"[:letters]) for _ in range(rng.randrange(40))]
        at = rng.randrange(350)
        part = base[at : at + rng.randrange(60)]
        if part and rng.random() < 0.4:
            part[rng.randrange(len(part))] = "z"
        rows.append((i * 7 % 31, " ".join(words + part + ["y"] * (i % 3))))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = substrings.digest(substrings.remove_repeats(df, window)).collect()
    assert sorted(map(tuple, got), key=str) == removed(rows, window)


def test_levels_double_up_to_the_window():
    assert substrings.levels(50) == [7, 13, 25, 50] and substrings.levels(7) == [7] and substrings.levels(3) == [3]


def thue_morse(a, b, times=10):
    """Two words that every polynomial modulo 2^64 takes for equal."""
    x, y = a, b
    for _ in range(times):
        x, y = x + y, y + x
    return x, y


def test_words_that_collide_modulo_a_power_of_two(spark):
    one, other = thue_morse("a", "b")
    assert len(one) == 1024
    rest = " ".join(f"w{k}" for k in range(49))
    rows = [(1, f"{one} {rest}"), (2, f"{other} {rest}")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = substrings.digest(substrings.remove_repeats(df)).collect()
    assert sorted(map(tuple, got), key=str) == removed(rows, 50) and {r.n_removed for r in got} == {0}
    alone = [(1, one), (2, other), (3, one)]
    got = near_duplicates.near_duplicates(spark.createDataFrame(alone, "doc_id bigint, text string"), shingle=4)
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got.collect()) == [(1, 1, True), (2, 2, True), (3, 1, False)]
    # The same pattern of words, in windows longer than the contract's.
    first, second = (" ".join(x) for x in thue_morse("a", "b", 11))
    words = [(1, first), (2, second)]
    got = substrings.digest(substrings.remove_repeats(spark.createDataFrame(words, "doc_id bigint, text string"), 2048))
    assert {r.n_removed for r in got.collect()} == {0}


def shuffle_files(spark):
    """Shuffle files on this session's disk; they are deleted in the background, so wait until their number stands."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    found, last = None, set()
    while found != last:
        found = last
        time.sleep(1)
        last = {f for d in folders for f in Path(d.getPath()).rglob("shuffle_*.data")}
    return last


def test_only_what_the_result_is_read_from_stays_on_disk(spark, docs, rows):
    docs.count()
    paths, files = session.work_paths(spark), shuffle_files(spark)
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    found = substrings.digest(substrings.remove_repeats(docs))
    made = [p.split("/")[-1].rsplit("-", 1)[0] for p in session.work_paths(spark) if p not in paths]
    assert made == ["settled", "alive-blocks"]
    assert not shuffle_files(spark) - files
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
    # The result can be read as often as one likes.
    for _ in range(2):
        assert sorted(map(tuple, found.collect()), key=str) == removed(rows, 50)


def test_what_is_kept_alone_leaves_other_shuffles(spark):
    """Those of a cached input stay, and the setting returns even if the step fails."""
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    others, made = shuffle_files(spark), []
    cached = spark.range(1000).repartition(5, "id").cache()
    cached.write.format("noop").mode("overwrite").save()  # without a shuffle of its own
    of_cached = shuffle_files(spark) - others
    kept = keep_alone(cached.groupBy((F.col("id") % 7).alias("k")).count(), "sevenths", made)
    assert kept.count() == 7 and len(made) == 1
    assert of_cached and of_cached <= shuffle_files(spark)
    with pytest.raises(Exception, match="no such row"):
        keep_alone(cached.select(F.raise_error(F.lit("no such row")).alias("x")), "fails", made)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
    session.discard(spark, made)
    cached.unpersist()


def test_columns_of_any_name(spark):
    text = " ".join(f"w{k}" for k in range(60))
    names = ["_kept", "a.b", "a`b", "_id", "_found", "gone", "id", "anchor", "n_chars", "kept"]
    schema = "doc_id int, text string, " + ", ".join("`" + n.replace("`", "``") + "` int" for n in names)
    df = spark.createDataFrame([(i, text, *range(len(names))) for i in (1, 2)], schema)
    short = substrings.shortened(df)
    assert short.schema.names == df.schema.names and sorted(r.text for r in short.collect()) == ["", text]
    assert sorted(tuple(r)[2:10] for r in short.collect()) == [tuple(range(8))] * 2
    one = near_duplicates.one_of_each(df)
    assert one.schema.names == df.schema.names and [tuple(r) for r in one.collect()] == [(1, text, *range(len(names)))]


def test_signature_tokens_of_strangers_differ():
    """Random sets of 1,000 shingles: no value is shared by chance."""
    rng = np.random.default_rng(8)
    factor, seen = near_duplicates._FACTORS[0], []
    for _ in range(20):
        hashes = rng.integers(0, 1 << 64, size=(5_000, 1_000), dtype=np.uint64)
        seen.append(near_duplicates.mix((hashes * factor).min(axis=1) ^ factor))
    assert len(np.unique(np.concatenate(seen))) == 100_000


def shingle_set(text, size):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def groups(rows, size):
    sets = {i: shingle_set(t, size) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return [(i, len(sets[i]), root(i), root(i) == i) for i in ids]


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates_equal_brute_force(unique_docs, unique_rows, size):
    got = near_duplicates.near_duplicates(unique_docs, shingle=size).drop("class_id").orderBy("doc_id")
    assert [tuple(r) for r in got.collect()] == groups(unique_rows, size)


def test_chains_and_lists_in_several_components(spark):
    """Copies that drift apart: links between neighbours only; an edited tail shared by all."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows = []
    for i in range(40):
        for _ in range(6):
            words[rng.randrange(300)] = f"w{rng.randrange(10**6)}"
        rows.append((i * 3 % 41, " ".join(words)))
    other = [f"v{rng.randrange(10**6)}" for _ in range(120)]
    rows += [(100 + i, " ".join(other[: 60 + 3 * i] + [f"u{i}"] * 2)) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = near_duplicates.near_duplicates(docs, shingle=4).drop("class_id").orderBy("doc_id")
    assert [tuple(r) for r in got.collect()] == groups(sorted(rows), 4)


def test_repeated_rows_and_null_ids(docs, rows):
    got = near_duplicates.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert {(r.component_id, r.kept) for r in got if r.doc_id is None} == {(None, True)}
    assert all(r.component_id == 5 and r.kept for r in got if r.doc_id == 5)


def test_one_of_each_group(unique_docs, unique_rows):
    kept = near_duplicates.one_of_each(unique_docs)
    assert kept.columns == unique_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _, _, k in groups(unique_rows, 5) if k]


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (300, 200)]
    got = components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    expected = {(i, 0) for i in range(1, 41)} | {(k, 100) for k in range(101, 130)} | {(300, 200)}
    assert {tuple(r) for r in got} == expected


def test_edited_and_following_texts(docs, rows):
    got = simhash.compared(docs).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [t or "" for _, t in ordered]
    expected = []
    for k, (i, _) in enumerate(ordered):
        text, following = texts[k], texts[(k + 1) % len(texts)]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        expected.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], key=str) == sorted(expected, key=str)
    by_id = {r.doc_id: r for r in got}
    assert len({by_id[i].fingerprint for i in range(80, 86)}) == 1
    assert by_id[80].near_next == 1.0 and by_id[90].fingerprint == "0" * 16
    assert np.mean([r.near_edited for r in got]) > np.mean([r.near_next for r in got])


def test_fingerprint_is_the_weighted_vote(spark):
    text = "one two two three"
    hashes = spark.createDataFrame([(w, v) for w, v in zip(text.split(), text.split()[1:] + [None])], "w string, v string")
    votes = [0] * 64
    for r in hashes.selectExpr("xxhash64(w) AS a", "xxhash64(w, v) AS b", "v").collect():
        for bit in range(64):
            votes[bit] += 1 if r.a >> bit & 1 else -1
            if r.v is not None:
                votes[bit] += simhash.PAIR_WEIGHT * (1 if r.b >> bit & 1 else -1)
    expected = sum(1 << bit for bit in range(64) if votes[bit] > 0)
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert simhash.compared(docs).first().fingerprint == f"{expected:016x}"


def test_simhash_takes_the_limits_of_buckets_once(unique_docs, monkeypatch):
    """Sketches that differ from one computation to the next change nothing."""
    expected, whole, calls = sorted(simhash.compared(unique_docs).collect()), F.percentile_approx, []

    def unequal(*args):
        calls.append(args)
        shift = 2 * len(calls)
        return F.transform(whole(*args), lambda x: x + shift)

    monkeypatch.setattr(F, "percentile_approx", unequal)
    assert sorted(simhash.compared(unique_docs).collect()) == expected


def test_all_fingerprints_within_the_radius(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(40)]
    found = list(base)
    for b in base:
        for flips in (0, 1, 2, 3, 4):
            value = b
            for bit in rng.sample(range(64), flips):
                value ^= 1 << bit
            found.append(value)
    signed = [v - (1 << 64) * (v >> 63) for v in found]
    classes, pairs = simhash.within_radius(spark.createDataFrame(list(enumerate(signed)), "id bigint, bits bigint"))
    first = {}
    for i, v in enumerate(found):
        first.setdefault(v, i)
    assert {r.id: r.class_id for r in classes.collect()} == {i: first[v] for i, v in enumerate(found)}
    expected = {
        (min(a, b), max(a, b), (x ^ y).bit_count())
        for x, a in first.items()
        for y, b in first.items()
        if a < b and (x ^ y).bit_count() <= 3
    }
    assert {tuple(r) for r in pairs.collect()} == expected


def test_empty_tables(no_docs):
    assert substrings.remove_repeats(no_docs).count() == 0
    assert near_duplicates.near_duplicates(no_docs).count() == 0
    assert near_duplicates.one_of_each(no_docs).count() == 0
    assert simhash.compared(no_docs).count() == 0
