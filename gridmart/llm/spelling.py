"""Spelling variants: words within one error of each other, grouped under the most frequent form.

1. Words are counted: runs of ASCII letters and U+00C0 to U+00FF, of which A-Z become lower case. Each task adds up its own texts first
   (at most ``HELD`` different words at a time), so that a frequent word is a few rows in the shuffle.
2. Words of ``LETTERS`` or more that occur ``OCCURRENCES`` times or more are the vocabulary. Of two words with one error between
   them, the shorter one's first or second half stands unchanged in both, at the same end. So each word is
   posted under both halves for its own length, and for that of a word one shorter, and a near pair meets under one of its keys at least.
3. Keys are dealt into shards of about ``SHARD`` words. A task builds a bidirectional FM-index over a shard's words and searches
   for each of them: one half exactly, the other with one error (`fm_index`).
4. A word's form is its nearest word of the highest count, if that is ``TIMES`` its own or more; following forms leads to
   the root. Counts grow along a chain, so a number of pointer doublings that the highest count bounds reaches every root.

Hot keys: the words of a key with more than ``CROWD`` are dealt into blocks by hash; each is indexed in one block and searched for
in all, streaming, so memory stays that of a block.

Edge cases: NULL texts have no words; rows with a NULL id count like others (their id is an empty string where
damage is picked). Repeated rows count as often as they are there. Words of any length are handled whole, in time
proportional to it. A table without such words gives no row.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gridmart.llm.fm_index import STEP, Index
from gridmart.llm.tables import keep
from gridmart.llm.words import texts_of
from gridmart.operators.codes import small_side

LETTERS = 6
OCCURRENCES = 5
TIMES = 5
HELD = 500_000
SHARD = 20_000
CROWD = 10_000

#: Typos of the registered query: one run in so many loses a letter.
TYPO = 199

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ASCII = bytes(b if 97 <= b <= 122 else 32 for b in _LOWER)

#: From a document's id and one of its words (UTF-8, lower case) to the word that counts.
Change = Callable[[bytes, bytes], bytes]


def typo(doc_id: bytes, word: bytes) -> bytes:
    """The word without one letter where crc32 of ``doc_id:word`` is divisible by ``TYPO``."""
    h = zlib.crc32(word, zlib.crc32(doc_id + b":"))
    if h % TYPO:
        return word
    shown = word.decode()
    place = h % len(shown)
    return (shown[:place] + shown[place + 1 :]).encode()


def words_of(text: bytes, letters: int = LETTERS) -> list[bytes]:
    """Runs of ``letters`` letters or more, with A-Z in lower case."""
    if text.isascii():
        return [w for w in text.translate(_ASCII).split() if len(w) >= letters]
    shown = text.translate(_LOWER).decode("utf-8", "replace")
    return [w.encode() for w in re.findall("[a-zÀ-ÿ]{%d,}" % letters, shown)]


def _count(change: Change | None, letters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def told() -> pa.RecordBatch:
            words = pa.array(list(held), pa.string())
            numbers = pa.array(list(held.values()), pa.int64())
            held.clear()
            return pa.RecordBatch.from_arrays([words, numbers], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                found = Counter(words_of(text, letters)) if text else {}
                if change is None:
                    held.update(found)
                else:
                    own = b"" if doc_id is None else b"%d" % doc_id
                    for word, n in found.items():
                        held[change(own, word)] += n
                if len(held) >= HELD:
                    yield told()
        if held:
            yield told()

    return run


def count_words(
    docs: DataFrame, text: str = "text", change: Change | None = None, letters: int = LETTERS, least: int = OCCURRENCES
) -> DataFrame:
    """``word, n`` of all words with ``letters`` or more that occur ``least`` times or more."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col(text).cast("string"))
    counted = rows.mapInArrow(_count(change, letters), "word string, n bigint")
    return (
        counted.filter(F.length("word") >= letters).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    )


def _keys(least: int) -> Column:
    """The halves of a word, for its length and for one less."""
    size = F.length("word")

    def halves(shorter: int) -> list[Column]:
        n = (size - shorter).cast("int")
        front = F.floor(n / 2).cast("int")
        first = F.struct(n.alias("n"), F.lit(True).alias("front"), F.substring("word", F.lit(1), front).alias("half"))
        last = F.struct(
            n.alias("n"), F.lit(False).alias("front"), F.substring("word", size - (n - front) + 1, n - front).alias("half")
        )
        return [first, last]

    both = F.array(*halves(0), *halves(1))
    return F.when(size > least, both).otherwise(F.array(*halves(0)))


def _postings(vocabulary: DataFrame, least: int) -> DataFrame:
    """``key, block, word, n, indexed``."""
    posted = vocabulary.select("word", "n", F.explode(_keys(least)).alias("key"))
    # One row per CROWD postings at most.
    crowded = (
        posted.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > CROWD)
        .select(F.col("key").alias("hot"), F.ceil(F.col("size") / CROWD).cast("int").alias("blocks"))
    )
    dealt = posted.join(small_side(crowded), F.col("key") == F.col("hot"), "left")
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("word"), blocks).cast("int")
    return dealt.select(
        "key", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), "word", "n", own.alias("own")
    ).select("key", "block", "word", "n", (F.col("block") == F.col("own")).alias("indexed"))


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard, indexed ones first, to near pairs."""
    shard = index = None
    held: dict[str, int] = {}
    words: list[str] = []
    asked: list[str] = []

    def answers(queries: list[str]) -> pa.RecordBatch:
        a, b = index.near(queries)
        near = [words[i] for i in b.tolist()]
        columns = [
            pa.array([queries[i] for i in a.tolist()], pa.string()),
            pa.array(near, pa.string()),
            pa.array([held[w] for w in near], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["word", "near", "near_n"])

    def build() -> Iterator[pa.RecordBatch]:
        nonlocal index, words
        words = list(held)
        index = Index(words)
        yield answers(words)

    def finish() -> Iterator[pa.RecordBatch]:
        nonlocal index, held, asked
        if held and index is None:
            yield from build()
        if asked:
            yield answers(asked)
        index, held, asked = None, {}, []

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("shard", "word", "n", "indexed"))
        for own, word, n, indexed in zip(*columns, strict=True):
            if own != shard:
                yield from finish()
                shard = own
            if indexed:
                held[word] = n
                continue
            if index is None:
                yield from build()
            if word not in held:
                asked.append(word)
            if len(asked) >= STEP:
                yield answers(asked)
                asked = []
    yield from finish()


def near_pairs(vocabulary: DataFrame, least: int = LETTERS) -> DataFrame:
    """``word, near, near_n``: all pairs of words (``least`` letters or more) with one error between them, both ways."""
    postings = keep(_postings(vocabulary, least), "postings")
    shards = max(1, -(-postings.count() // SHARD))
    shard = F.pmod(F.xxhash64("key", "block"), F.lit(shards)).alias("shard")
    # Compute follows the words, not the bytes: the number of tasks is given.
    found = (
        postings.select(shard, "word", "n", "indexed")
        .repartition(min(shards, 10_000), "shard")
        .sortWithinPartitions("shard", F.desc("indexed"))
        .mapInArrow(_search, "word string, near string, near_n bigint")
    )
    return found.groupBy("word", "near").agg(F.any_value("near_n").alias("near_n"))


def _roots(forms: DataFrame, highest: int) -> DataFrame:
    """``word, root`` of all words with a form, by pointer doubling."""
    roots = keep(forms.select("word", F.col("form").alias("root")), "roots")
    links = 1
    while highest >= TIMES**links:
        links += 1
    for _ in range(links.bit_length()):
        onward = roots.select(F.col("word").alias("w"), F.col("root").alias("next"))
        stepped = roots.join(onward, F.col("root") == F.col("w"), "left")
        roots = keep(stepped.select("word", F.coalesce("next", "root").alias("root")), "roots")
    return roots


def variants(vocabulary: DataFrame, least: int = LETTERS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of ``vocabulary`` (``word, n``; read several times)."""
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    near = near_pairs(vocabulary, least).groupBy(F.col("word").alias("w")).agg(
        F.count(F.lit(1)).alias("n_near"), best
    )
    follows = -F.col("best.less") >= TIMES * F.col("n")
    known = keep(
        vocabulary.join(near, F.col("word") == F.col("w"), "left").select(
            "word",
            F.when(follows, F.col("best.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(follows, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    highest = known.agg(F.max("n")).first()[0] or 0
    roots = _roots(known.filter("form IS NOT NULL"), highest).withColumnRenamed("word", "w")
    return known.join(roots, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
