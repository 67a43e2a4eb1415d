"""Decontamination, licence scan, language and quality against brute force or held-out labels."""

import random
import re
import zlib

import numpy as np
import pytest

from gridmart.llm import decontaminate, langid, licenses, quality
from gridmart.llm.tables import documents, read_table
from gridmart.llm.words import alnum_words

SF = "/root/testdata/sf0.01"
WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def test_words_are_those_of_the_pattern(rows):
    texts = [t for _, t in rows] + ["a_b`c{d}~\x7fé9\x00Z[\\]^", "\x80\x85 x", "日本,語"]
    for text in texts:
        assert [w.decode() for w in alnum_words(text.encode() if text else None)] == words_of(text)


def places_of(pattern, words):
    n = len(pattern)
    return [i for i in range(len(words) - n + 1) if words[i : i + n] == pattern]


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 900])
def test_decontamination_equals_brute_force(spark, docs, rows, block_bytes):
    rng = random.Random(4)
    texts = [t for _, t in rows if t]
    items = [(i, " ".join(rng.choice(texts).split()[: rng.choice([2, 9, 10, 25])])) for i in range(14)]
    items += [(20, "never heard of this one"), (21, "te"), (22, ""), (23, None), (24, "..."), (3, items[3][1])]
    items += [(25, items[0][1]), (None, texts[7])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.digest(decontaminate.occurrences(docs, bench, block_bytes=block_bytes)).collect()
    windows = []
    for i, text in items:
        words = words_of(text)
        n = min(10, len(words))
        windows += [(i, words[k : k + n]) for k in range(len(words) - n + 1) if n]
    expected = []
    for i, text in rows:
        words, hit, found = words_of(text), set(), set()
        for item, window in windows:
            for at in places_of(window, words):
                hit.update(range(at, at + len(window)))
                found |= {str(item)} if item is not None else set()
        expected.append((i, len(words), len(hit), len(found), bool(hit)))
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in got], key=str) == sorted(
        expected, key=str
    )


def test_repeated_items_are_dealt_once_into_bounded_blocks(spark):
    rows = [("same", "one two three " * 20)] * 500 + [(f"i{i}", f"item {i} " * 20) for i in range(100)]
    rows += [("same", "other text"), (None, "other text"), ("none", None)]
    bench = spark.createDataFrame(rows, "item_id string, text string").repartition(3)
    blocks = list(decontaminate.benchmark_blocks(bench, "item_id", "text", 2000))
    assert sorted(map(str, sum(blocks, []))) == sorted(str((i, t.encode())) for i, t in set(rows) if t)
    assert all(sum(len(t) for _, t in block) <= 2000 for block in blocks)
    assert len(blocks) < 20


def test_shift_table_skips():
    patterns = decontaminate.Patterns([("a", b"0 1 2 3 4 5 6 7 8 9"), ("b", b"8 9"), ("c", b"x")], 10)
    one, two, ten = patterns.tables
    assert (one.length, two.length, ten.length, ten.furthest) == (1, 2, 10, 9)
    number = patterns.numbers
    shifts = [ten.shift[number[b"%d" % k] * decontaminate.SPREAD + number[b"%d" % (k + 1)] & ten.mask] for k in range(9)]
    assert shifts == [8, 7, 6, 5, 4, 3, 2, 1, 0]
    assert ten.stops(number, b"0 1 2 3 4 5 6 7 8 9 8 9 z z".split()) == [10]


def test_search_equals_brute_force():
    rng = random.Random(12)
    for window in (1, 2, 3, 7):
        items = [(str(k % 9), " ".join(rng.choice("abc") for _ in range(rng.randrange(14)))) for k in range(14)]
        items.append((None, "a b"))
        patterns = decontaminate.Patterns([(i, t.encode()) for i, t in items], window)
        words = [rng.choice("abcd") for _ in range(300)]
        expected = {}
        for item, text in items:
            own = text.split()
            n = min(window, len(own))
            for k in range(len(own) - n + 1 if n else 0):
                for at in places_of(own[k : k + n], words):
                    expected.setdefault((at, at + n), set()).update({item} - {None})
        got = {}
        for first, stop, own in patterns.search([w.encode() for w in words]):
            got.setdefault((first, stop), set()).update(own)
        assert got == expected


def test_long_items_are_cut_into_pieces(spark):
    rng = random.Random(13)
    words = [str(rng.randrange(50)) for _ in range(2000)]
    bench = spark.createDataFrame([(1, " ".join(words)), (2, "1 2 3")], "item_id bigint, text string")
    blocks = list(decontaminate.benchmark_blocks(bench, "item_id", "text", 3000, 10, 300))
    pieces = [t.decode().split() for block in blocks for i, t in block if i == "1"]
    assert len(blocks) > 2 and all(len(p) <= 309 for p in pieces)
    windows = sorted(tuple(p[k : k + 10]) for p in pieces for k in range(len(p) - 9))
    assert windows == sorted(tuple(words[k : k + 10]) for k in range(1991))


def test_tables_of_a_full_block_are_bounded_and_built_once():
    rng = np.random.default_rng(14)
    items, size = [], 0
    while size < decontaminate.BLOCK_BYTES:
        text = " ".join(map(str, rng.zipf(1.3, 400) % 200_000)).encode()
        items.append((str(len(items)), text))
        size += len(text)
    patterns = decontaminate.patterns_of("block", items, 10)
    assert decontaminate.patterns_of("block", items, 10) is patterns
    arrays = [v for t in patterns.tables for v in vars(t).values() if isinstance(v, np.ndarray)]
    arrays += [np.frombuffer(t.shift, dtype=np.uint8) for t in patterns.tables]
    vocabulary = sum(len(w) + 120 for w in patterns.numbers)
    assert sum(a.nbytes for a in arrays) + vocabulary < 150 << 20
    own = items[5][1].split()
    found = list(patterns.search([b"before"] + own[3:60] + [b"after"]))
    assert len({f for f, _, _ in found}) == 48 and all("5" in o for _, _, o in found)


def test_clean_documents_keep_columns_and_rows(spark, docs, rows):
    bench = spark.createDataFrame([(1, rows[3][1])], "item_id bigint, text string")
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 1
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.clean(docs, nothing).count() == len(rows)


def test_licence_places_equal_brute_force(spark, rows):
    rng = random.Random(9)
    parts = "gnu general public license apache cc by mit the by-nc version License, MIT-License Apache".split()
    texts = [t for _, t in rows] + [" ".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in licenses.digest(licenses.scan(docs)).collect()}
    for i, text in enumerate(texts):
        words = words_of(text)
        found = [(at, label) for p, label in licenses.BASE for at in places_of(p.split(), words)]
        starts = [at for at, _ in found]
        expected = (len(words), len(found), min(starts, default=None), max(starts, default=None))
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == expected, text
        assert r.base_labels == ",".join(sorted({label for _, label in found}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_matching_statistics_equal_brute_force():
    rng = random.Random(1)
    templates = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 25))) for _ in range(6)]
    scanner = licenses.Scanner([], [(str(i), " ".join(t)) for i, t in enumerate(templates)])
    text = "".join(rng.choice("abcd") for _ in range(400))
    got = {i: size for i, _, size in scanner.statistics([c.encode() for c in text])}
    for i in range(len(text)):
        longest = max(n for n in range(26) if n == 0 or n <= i + 1 and any(text[i - n + 1 : i + 1] in t for t in templates))
        assert got.get(i, 0) == longest
    for state in range(1, len(scanner.automaton.link)):
        assert scanner.automaton.ends[state]


def matching_runs(words, template, least):
    """Maximal equal runs: (first, stop, begin)."""
    for first in range(len(words)):
        for begin in range(len(template)):
            if first and begin and words[first - 1] == template[begin - 1]:
                continue
            n = 0
            while first + n < len(words) and begin + n < len(template) and words[first + n] == template[begin + n]:
                n += 1
            if n >= least:
                yield first, first + n, begin


def best_cover(words, template):
    """The most words of a template that any chain of runs covers, by trying all chains."""
    runs = sorted(matching_runs(words, template, licenses.MIN_MATCH))

    def upto(run):
        return run[2] + run[1] - run[0]

    def longest(last, covered):
        best = covered
        for r in runs:
            forward = r[0] > last[0] and r[2] > last[2] and r[1] > last[1] and upto(r) > upto(last)
            if forward and r[0] - last[1] <= licenses.MAX_GAP:
                more = r[1] - r[0] - max(0, last[1] - r[0], upto(last) - r[2])
                if more > 0:
                    best = max(best, longest(r, covered + more))
        return best

    return max((longest(r, r[1] - r[0]) for r in runs), default=0)


def test_chains_equal_brute_force():
    """Templates that repeat their phrases, texts made of their pieces."""
    rng = random.Random(4)
    hits = 0
    for _ in range(120):
        templates = [[rng.choice("abc") for _ in range(rng.randrange(8, 22))] for _ in range(3)]
        text = []
        while len(text) < 40:
            t = rng.choice(templates)
            at = rng.randrange(len(t))
            text += t[at : at + rng.randrange(3, 9)] + [rng.choice("abcx")] * rng.randrange(3)
        scanner = licenses.Scanner([], [(str(k), " ".join(t)) for k, t in enumerate(templates)])
        _, found = scanner.scan([c.encode() for c in text])
        for k, t in enumerate(templates):
            own = sorted((f["first"], f["stop"]) for f in found if f["label"] == str(k))
            share = max((f["share"] for f in found if f["label"] == str(k)), default=0)
            cover = best_cover(text, t)
            expected = min(1.0, cover / len(t)) if cover >= licenses.MIN_COVER * len(t) else 0
            assert share == expected, (text, t)
            assert all(a[1] <= b[0] for a, b in zip(own, own[1:]))
            hits += bool(own)
    assert hits > 60


@pytest.mark.parametrize("taken", [13, 17])
def test_a_phrase_that_a_template_has_twice(taken):
    phrase = ["in", "the", "hope", "that"]
    template = [f"w{k}" for k in range(20)]
    template[2:6] = template[12:16] = phrase
    words = template[:taken]
    words.insert(8, "foreign")
    scanner = licenses.Scanner([], [("x", " ".join(template))])
    _, found = scanner.scan([w.encode() for w in words])
    assert [(f["label"], f["first"], f["stop"]) for f in found] == [("x", 0, taken + 1)]
    assert found[0]["share"] == taken / 20


def test_whole_licences_are_found(spark):
    whole = {label: text for label, text in licenses.TEMPLATES if label.endswith("-whole")}
    assert len(whole) == 8 and all(len(t.split()) > 25 for t in whole.values())
    rows = [(i, "some code\n" + text + "\nmore code " + text) for i, text in enumerate(whole.values())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.row.doc_id: r.out.covered for r in licenses.scan(docs).collect()}
    for i, label in enumerate(whole):
        own = [c for c in got[i] if c.label == label]
        assert [c.share for c in own] == [1.0, 1.0], label
        others = {c.label for c in got[i]} & whole.keys() - {label}
        # The two- and the three-clause text share most of their words.
        assert others <= {"bsd-2-clause-whole", "bsd-3-clause-whole"}, (label, others)


def test_covered_spans_of_templates(spark):
    text = dict(licenses.TEMPLATES)["bsd-text"]
    changed = text.replace("binary forms", "some forms")
    docs = spark.createDataFrame([(1, "intro " + text), (2, changed), (3, text[:40]), (4, None)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in licenses.digest(licenses.scan(docs)).collect()}
    assert got[1].labels == "bsd-text" and got[1].score == 1.0
    assert got[2].labels == "bsd-text" and 0.8 < got[2].score < 1.0
    assert (got[3].labels, got[3].score, got[4].score) == ("", 0.0, 0.0)


def held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_language_of_held_out_documents(spark):
    docs = documents(spark, SF)
    got = langid.digest(langid.predict(docs, langid.fit(docs))).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == held_out(r.doc_id) for r in got)
    right = [r.lang == r.lang_pred for r in got if r.held_out and r.lang]
    assert np.mean(right) > 0.97
    assert np.mean([r.accepted for r in got]) > 0.95


def test_language_of_awkward_texts(spark, docs, rows, no_docs):
    fitted = langid.fit(docs)
    got = [r for r in langid.predict(docs, fitted).select("row.text", "out.*").collect()]
    assert len(got) == len(rows)
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters)
        assert letters or not r.accepted and r.score == 0
    assert langid.fit(no_docs) == {}
    assert {r.lang_pred for r in langid.predict(docs, {}).select("out.*").collect()} == {"und"}
    assert langid.accepted(no_docs).count() == 0
    assert langid.accepted(docs).columns == docs.columns


def test_copies_take_one_place_in_a_language_sample(spark):
    """Every text has more copies than there are places."""
    texts = [f"only {chr(97 + i // 26)}{chr(97 + i % 26)}q here" for i in range(70)]
    rows = [(i, texts[i % 70], "xx") for i in range(70 * 2 * langid.SAMPLE_TEXTS)]
    learned = langid.fit(spark.createDataFrame(rows + rows, "doc_id bigint, text string, lang string"))["xx"].decode()
    assert sum(t in learned for t in texts) == langid.SAMPLE_TEXTS


def test_language_samples_are_filled_from_the_whole_of_texts(spark):
    rng = random.Random(4)

    def prose(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))

    header = "zzzzz " * 400
    long, short = [header + prose(2000) for _ in range(10)], ["12 " * 900 + w for w in ("klmn", "nmlk")]
    ids = [i for i in range(100) if not held_out(i)]
    rows = [(i, t, "xx") for i, t in zip(ids, long + short)]
    rows += [(i, f"yy {t}", "yy") for i, t in zip(ids[20:], short)]
    got = langid.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert langid.SAMPLE_BYTES - 100 < len(got["xx"]) <= langid.SAMPLE_BYTES
    assert b"klmn" in got["xx"] and b"nmlk" in got["xx"]
    assert got["xx"].count(b"zzzzz") < 0.4 * len(got["xx"]) / 6
    assert sorted(got["yy"].split()) == [b"klmn", b"nmlk", b"yy", b"yy"]
    learned = set(got["xx"].split())
    for text in long:  # every stretch of every text
        words = text.encode().split()
        assert all(learned.intersection(words[a : a + 700]) for a in range(400, 1700, 650))


def test_parts_and_spans_of_texts():
    assert langid.parts([5, 100, 1000, 0], 300) == [5, 100, 195, 0]
    assert sorted(langid.parts([700, 700], 1001)) == [500, 501]
    for size, part in ((10, 10), (10, 0), (10_000, 9_999), (10_000, 769), (5_000, 768), (200_000, 49_152)):
        found = langid.spans(size, part, -3)
        assert all(0 <= a <= b <= size for a, b in found)
        assert all(b <= c for (_, b), (c, _) in zip(found, found[1:]))
        assert sum(b - a for a, b in found) + max(len(found) - 1, 0) == part


def test_quality_of_held_out_documents(spark):
    docs, labels = documents(spark, "/root/testdata/sf0.1"), read_table(spark, "/root/testdata/sf0.1", "labels")
    found = quality.digest(quality.score(docs, quality.fit(docs, labels)))
    got = found.join(labels, "doc_id").filter("held_out").collect()
    scores, true = np.array([r.score for r in got]), np.array([r.quality for r in got])
    order = np.empty(len(scores))
    order[np.argsort(scores)] = np.arange(len(scores))
    positive = true == 1
    area = (order[positive].mean() - (positive.sum() - 1) / 2) / (~positive).sum()
    assert area > 0.95
    assert np.mean([r.predicted == r.quality for r in got]) > 0.97


def test_quality_of_awkward_texts(spark, docs, rows, no_docs):
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(30)] + [(1, 0, 0), (None, 1, 0), (2, None, 0)], "doc_id bigint, quality int, toxic int")
    got = quality.digest(quality.score(docs, quality.fit(docs, labels))).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    none = quality.fit(docs, labels.filter("quality = 0"))
    assert {r.score for r in quality.digest(quality.score(docs, none)).collect()} == {0.5}
    assert quality.digest(quality.score(no_docs, quality.fit(no_docs, labels))).count() == 0


@pytest.mark.parametrize("share", [0.15, 0.5, 0.8])
def test_prior_of_mixtures(share):
    """Good and bad rows from known distributions that overlap a little."""
    rng = np.random.default_rng(int(share * 100))
    n = 4000
    positive = rng.normal(1.2, 1, size=(n, quality.FEATURES))
    unlabelled = np.where(
        (np.arange(n) < share * n)[:, None],
        rng.normal(1.2, 1, size=(n, quality.FEATURES)),
        rng.normal(-1.2, 1, size=(n, quality.FEATURES)),
    )
    found = quality.estimate_prior(positive, unlabelled)
    assert abs(found - share) < 0.06
    assert found == quality.estimate_prior(rng.permutation(positive), rng.permutation(unlabelled))


def test_prior_is_near_the_labelled_share(spark):
    """Labels are a random sample here, so the negatives that the estimate doesn't see confirm it."""
    docs, labels = documents(spark, "/root/testdata/sf0.1"), read_table(spark, "/root/testdata/sf0.1", "labels")
    good = labels.filter("quality = 1").select("doc_id")
    x = quality._statistics(docs.join(good, "doc_id"), "text")
    u = quality._statistics(docs, "text")
    share = good.count() / labels.filter("quality IS NOT NULL").count()
    assert abs(quality.estimate_prior(x, u) - share) < 0.1


def test_fit_is_where_the_risk_is_least():
    """The weights against small steps away from them, on the clipped and penalised risk."""
    rng = np.random.default_rng(7)
    positive = rng.normal(0.8, 1, size=(300, quality.FEATURES))
    unlabelled = np.vstack([rng.normal(0.8, 1, size=(300, quality.FEATURES)), rng.normal(-0.8, 1, size=(300, quality.FEATURES))])
    model = quality.minimise(positive, unlabelled, 0.5)

    def value(weights):
        as_bad, as_good = quality.risk(quality.Model(model.centre, model.scale, weights), positive, unlabelled, 0.5)
        return as_bad + max(0.0, as_good) + quality.L2 / 2 * (weights[:-1] ** 2).sum()

    base, start = value(model.weights), value(np.zeros_like(model.weights))
    assert base < 0.5 * start
    for _ in range(40):
        assert value(model.weights + rng.normal(size=len(model.weights)) * 0.3) > base - 1e-3


def test_risk_never_goes_far_below_zero():
    """Few positives that could be told apart by chance: the fit must not run off."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, quality.FEATURES))
    model = quality.minimise(x[:20], x, 0.9)
    assert np.isfinite(model.weights).all() and np.mean(model.score(x) > 0.5) > 0.7
