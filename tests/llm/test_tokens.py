"""Token ids, Simple-8b files and packing against plain encoding and brute force."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from gridmart.llm import packing, simple8b
from gridmart.llm.tokens import Encoder

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


def plain(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda t: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, dtype="<u4")


@pytest.mark.parametrize("name", FILES)
def test_remembered_chunks_give_the_ids_of_whole_texts(name):
    ours, theirs = Encoder(public_tokenizers.path(name)), plain(name)
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab é'\n \t s1.ΣİíK日\U0001f600\xa0 ") for _ in range(30)) for _ in range(1500)]
    texts += ["", " ", "\n", " \n a", "a\n\nb", "<|endoftext|> x <|endoftext|>", "don't  it's 12 x²½"]
    assert [t for t in texts if ours.encode(t) != theirs(t).tobytes()] == []
    assert ours.encode(None) == b""


@pytest.mark.parametrize("name", FILES)
def test_special_strings_at_every_place(name):
    ours, theirs = Encoder(public_tokenizers.path(name)), plain(name)
    around = ["Don't stop, é 12.", "a\n\n b ", " ", "", "<|", "|> \n", "e\u0301"]
    special = ["<|endoftext|>", "<|startoftext|>", "<|endoftext|", "<|endoftext|><|endoftext|>"]
    texts = [a[:i] + s + a[i:] + b for a in around for i in range(len(a) + 1) for s in special for b in around]
    rng = random.Random(2)
    texts += ["".join(rng.choice([*special, *around, "x", " "]) for _ in range(8)) for _ in range(1500)]
    assert [t for t in texts if ours.encode(t) != theirs(t).tobytes()] == []
    assert ours.encode("a<|endoftext|>").endswith(theirs("<|endoftext|>").tobytes())


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 40) | st.just(0) | st.integers(32000, 33000)))
@settings(max_examples=200, deadline=None)
def test_simple8b_round_trip(ids):
    ids = np.array(ids, dtype=np.uint32)
    words, escapes = simple8b.pack(ids)
    assert (simple8b.unpack(words, escapes, len(ids)) == ids).all()


def test_small_ids_share_words():
    words, escapes = simple8b.pack(np.zeros(6000, dtype=np.uint32))
    assert len(words) == 100 and not len(escapes)
    assert len(simple8b.pack(np.full(4000, 30000, dtype=np.uint32))[0]) == 1000


def test_files_hold_every_document_in_order(spark, docs, rows, tmp_path):
    path = str(tmp_path / "ids")
    simple8b.write(docs, path, public_tokenizers.path(FILES[0]), shards=3)
    got = simple8b.read(spark, path).orderBy("start").collect()
    encode = plain(FILES[0])
    expected, at = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.append(encode(text), 0).astype("<u4").tobytes()
        expected.append((i, at, len(ids) // 4, zlib.crc32(ids), ids))
        at += len(ids) // 4
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in got] == expected


def test_files_of_no_documents(spark, no_docs, tmp_path):
    simple8b.write(no_docs, str(tmp_path / "ids"), public_tokenizers.path(FILES[0]), shards=2)
    assert simple8b.read(spark, str(tmp_path / "ids")).count() == 0


def one_by_one(items, capacity):
    rooms = []
    for item in sorted(items, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= item]
        if fits:
            rooms[min(fits, key=rooms.__getitem__)] -= item
        else:
            rooms.append(capacity - item)
    return len(rooms)


@given(st.lists(st.integers(1, 30), max_size=60))
@settings(max_examples=200, deadline=None)
def test_histogram_packing_is_best_fit_and_no_worse_after_reduction(items):
    counts = Counter(items)
    grouped = packing.best_fit(counts, 30)
    assert sum(n for _, n in grouped) == one_by_one(items, 30)
    fixed, rest = packing.dominating(counts, 30)
    patterns = fixed + packing.best_fit(rest, 30)
    assert sum(n for _, n in patterns) <= one_by_one(items, 30)
    used = Counter()
    for content, n in patterns:
        assert n > 0 and sum(length * each for length, each in content) <= 30
        used.update({length: 0 for length, _ in content})
        for length, each in content:
            used[length] += each * n
    assert used == counts


def test_dominance_fixes_perfect_partners_and_lone_pieces():
    fixed, rest = packing.dominating({10: 2, 7: 3, 3: 1, 6: 1}, 10)
    assert ((((10, 1),), 2)) in fixed and ((((7, 1), (3, 1)), 1)) in fixed
    assert rest == {}


@pytest.mark.parametrize("bucket", [100_000, 2])
def test_packing_has_every_piece_once_without_gaps(docs, rows, bucket):
    cut = packing.pieces(docs, public_tokenizers.path(FILES[1]), ids=True)
    cut = cut.selectExpr("row.doc_id", "piece", "start", "length", "ids_crc32", "ids").cache()
    got = packing.pack(cut, bucket=bucket).collect()
    encode = plain(FILES[1])
    expected = Counter()
    for i, text in rows:
        ids = np.append(encode(text), 0).astype("<u4")
        for k, at in enumerate(range(0, len(ids), packing.CAPACITY)):
            own = ids[at : at + packing.CAPACITY].tobytes()
            expected[(i, k, at, len(own) // 4, zlib.crc32(own), own)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got) == expected
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert len(by_sequence) <= one_by_one([r.length for r in got], packing.CAPACITY)


def test_packing_no_documents(no_docs):
    assert packing.packed(no_docs, public_tokenizers.path(FILES[1])).count() == 0
