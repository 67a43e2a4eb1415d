"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the runs of ``window`` consecutive words of each benchmark item (all words of a shorter
item). For the patterns of one length, a shift table says for each block of two words how far the
search may move on (blocks share its cells by hash); only where the shift is 0 a bucket of patterns that end in this block is looked
up, within it by a hash of the words before, and direct comparison of all words confirms an occurrence.
Words are numbers of the benchmark's vocabulary; the tables are bytes and sorted arrays, some 30 bytes for a word of the benchmark.

The benchmark is a side input: it is broadcast in blocks of ``BLOCK_BYTES`` of text at most, one
pass over the documents for each block, with what was found so far stored in between. Items longer than ``PIECE_WORDS`` words
are cut into pieces that overlap by a window. Each worker process builds a block's tables once. Documents are not shuffled.

Edge cases: NULL and empty texts have no words, are hit nowhere and stay. Items without words give no
pattern. An item with a NULL id marks words, but is not listed. Repeated items and ids count once.
Repeated documents are judged row by row. An empty benchmark hits nothing.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridmart.llm.tables import keep
from gridmart.llm.words import alnum_words, mix, slices, texts_of

WINDOW = 10
BLOCK_BYTES = 8 << 20
#: Buckets of items per block, and words of a piece of an item.
DEALT = 64
PIECE_WORDS = 20_000
#: Cells of a shift table for each block of words, and what spreads blocks over them.
CELLS = 8
SPREAD = 0x9E3779B1

FOUND = "n_words: bigint, spans: array<struct<first: int, stop: int>>, items: array<string>"


class WuManber:
    """Patterns of ``length`` words: all windows of some items, given as arrays of word numbers."""

    def __init__(self, length: int, items: list[np.ndarray], owners: list[int]):
        self.length = length
        self.block = min(2, length)
        self.furthest = min(length - self.block + 1, 255)
        sizes = np.array([len(i) for i in items], dtype=np.int64)
        self.words = np.concatenate(items).astype(np.int32)
        item = np.repeat(np.arange(len(items)), sizes)
        place = np.arange(len(self.words)) - (np.cumsum(sizes) - sizes)[item]
        # How far a block's end is from the end of the first window that it is in. Blocks share the cells of a
        # table by hash, each cell has the least shift.
        ends = np.flatnonzero(place >= self.block - 1)
        self.mask = (1 << max(10, (CELLS * len(ends)).bit_length())) - 1
        cells = np.full(self.mask + 1, self.furthest, dtype=np.uint8)
        first = self.words[ends - self.block + 1].astype(np.int64)
        shift = np.clip(length - 1 - place[ends], 0, self.furthest).astype(np.uint8)
        np.minimum.at(cells, first * SPREAD + self.words[ends] & self.mask, shift)
        self.shift = cells.tobytes()
        # Windows in the order of their hashes: first by the block they end in, the bucket, then by all words.
        start = np.flatnonzero(place + length <= sizes[item])
        found = self._hashes(self.words[start[:, None] + np.arange(length)])
        order = np.argsort(found, kind="stable")
        self.found, self.start = found[order], start[order].astype(np.int32)
        self.owner = np.array(owners, dtype=np.int32)[item[self.start]]

    def _hashes(self, windows: np.ndarray) -> np.ndarray:
        """Bucket (the block at the end) in the upper half, and the words before it in the lower."""

        def of(words: np.ndarray) -> np.ndarray:
            h = np.zeros(len(words), dtype=np.uint64)
            for k in range(words.shape[1]):
                h = mix(h + words[:, k].astype(np.uint64) + np.uint64(1))
            return h >> np.uint64(32)

        return of(windows[:, -self.block :]) << np.uint64(32) | of(windows[:, : -self.block])

    def stops(self, numbers: dict[bytes, int], words: list[bytes]) -> list[int]:
        """Where a window may end: the places of shift 0 that the search comes to."""
        found, shift, mask, known, n = [], self.shift, self.mask, numbers.get, len(words)
        furthest, stop = self.furthest, self.length
        before = self.block  # the block's first word, counted from its end
        while stop <= n:
            last = known(words[stop - 1])
            first = known(words[stop - before]) if last is not None else None
            step = furthest if first is None else shift[first * SPREAD + last & mask]
            if step:
                stop += step
            else:
                found.append(stop)
                stop += 1
        return found

    def search(self, numbers: dict[bytes, int], words: list[bytes]):
        """(first, stop, owners) of every occurrence, by position."""
        length, stops = self.length, self.stops(numbers, words)
        if not stops:
            return
        known = numbers.get
        windows = np.array([[known(w, -1) for w in words[stop - length : stop]] for stop in stops], dtype=np.int64)
        wanted = self._hashes(windows)
        low, high = np.searchsorted(self.found, wanted, "left"), np.searchsorted(self.found, wanted, "right")
        for i in np.flatnonzero(low < high).tolist():
            own = {
                int(self.owner[j])
                for j in range(low[i], high[i])
                if (self.words[self.start[j] : self.start[j] + length] == windows[i]).all()
            }
            if own:
                yield stops[i] - length, stops[i], own


class Patterns:
    """The patterns of a block of items ``(id, text)``, one table for each length that occurs."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int):
        self.items = [item for item, _ in items]
        self.numbers: dict[bytes, int] = {}
        texts: dict[int, list[np.ndarray]] = defaultdict(list)
        owners: dict[int, list[int]] = defaultdict(list)
        for k, (_, text) in enumerate(items):
            words = alnum_words(text)
            if words:
                numbers = [self.numbers.setdefault(w, len(self.numbers)) for w in words]
                size = min(window, len(words))
                texts[size].append(np.array(numbers, dtype=np.int32))
                owners[size].append(k)
        self.tables = [WuManber(n, texts[n], owners[n]) for n in sorted(texts)]

    def search(self, words: list[bytes]):
        """(first, stop, items) of every occurrence."""
        for table in self.tables:
            for first, stop, own in table.search(self.numbers, words):
                yield first, stop, {self.items[k] for k in own} - {None}


_patterns: dict[tuple[str, int], Patterns] = {}


def patterns_of(name: str, items: list[tuple[str | None, bytes | None]], window: int) -> Patterns:
    """The tables of a block, built once in each worker process and kept until the next block comes."""
    key = name, window
    if key not in _patterns:
        _patterns.clear()
        _patterns[key] = Patterns(items, window)
    return _patterns[key]


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of spans, ascending and apart from each other."""
    merged: list[tuple[int, int]] = []
    for first, stop in sorted(spans):
        if merged and first <= merged[-1][1]:
            if stop > merged[-1][1]:
                merged[-1] = (merged[-1][0], stop)
        else:
            merged.append((first, stop))
    return merged


def _cut(window: int, most: int):
    """Items with more than ``most`` words as pieces that share all windows among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, texts = [], []
            for item, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                words = alnum_words(text) if len(text) > most else []
                if len(words) <= most:
                    items.append(item)
                    texts.append(text)
                    continue
                for at in range(0, len(words) - window + 1, most):
                    items.append(item)
                    texts.append(b" ".join(words[at : at + most + window - 1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(texts, pa.binary())], names=["item", "text"]
            )

    return run


def benchmark_blocks(
    benchmark: DataFrame, item_id: str, text: str, block_bytes: int, window: int = WINDOW, piece_words: int = PIECE_WORDS
):
    """The benchmark's different items in blocks of bounded size; only one block at a time is on the driver.

    Items are dealt by hash over ``DEALT`` buckets per block in the mean, and buckets are joined to blocks in order: a
    block is over ``block_bytes`` only if it is a single bucket.
    """
    items = benchmark.select(
        F.col(item_id).cast("string").alias("item"),
        F.col(text).cast("binary").alias("text"),
    ).filter(F.length("text") > 0)
    items = keep(items.mapInArrow(_cut(window, piece_words), items.schema).distinct(), "items")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = DEALT * -(-total // block_bytes)
    bucket = F.pmod(F.xxhash64("item", "text"), F.lit(max(buckets, 1)))
    if total <= block_bytes:
        ranges = [(0, max(buckets, 1))]
    else:
        sizes = items.groupBy(bucket.alias("bucket")).agg(F.sum(F.length("text")).alias("size"))
        ranges = joined([tuple(r) for r in sizes.orderBy("bucket").collect()], block_bytes)
    for first, stop in ranges:
        own = items.filter((bucket >= first) & (bucket < stop))
        yield [(r["item"], bytes(r["text"])) for r in own.collect()]


def joined(sizes: list[tuple[int, int]], limit: int) -> list[tuple[int, int]]:
    """Ranges of buckets, given as (bucket, size) in order, that hold ``limit`` at most or are one bucket."""
    ranges: list[tuple[int, int]] = []
    held = 0
    for bucket, size in sizes:
        if ranges and held + size <= limit:
            ranges[-1] = (ranges[-1][0], bucket + 1)
            held += size
        else:
            ranges.append((bucket, bucket + 1))
            held = size
    return ranges


def occurrences(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``row`` (the document) and ``out``: its number of words, the covered spans and the items."""
    context = docs.sparkSession.sparkContext
    found = docs.select(F.struct("*").alias("row")).withColumn("out", F.lit(None).cast(f"struct<{FOUND}>"))
    for k, block in enumerate(benchmark_blocks(benchmark, item_id, item_text, block_bytes, window)):
        if k:
            found = keep(found, "searched")  # the next block's pass begins when this one is done
        sent = context.broadcast((uuid.uuid4().hex, block))
        found = found.mapInArrow(_search(sent, window, text), found.schema)
    return found


def _search(sent, window: int, text: str):
    """One block's pass: spans and items are added to those of the passes before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = patterns_of(*sent.value, window)

        def one(text: bytes | None, before: dict | None) -> dict:
            words = alnum_words(text)
            spans = [(s["first"], s["stop"]) for s in before["spans"]] if before else []
            items = set(before["items"]) if before else set()
            for first, stop, own in patterns.search(words):
                spans.append((first, stop))
                items |= own
            merged = [{"first": a, "stop": b} for a, b in merge(spans)]
            return dict(n_words=len(words), spans=merged, items=sorted(items))

        for batch in batches:
            rows, before = batch.column(0), batch.column(1)
            texts = texts_of(rows.field(text))
            for begin, end in slices(texts):
                earlier = before.slice(begin, end - begin).to_pylist()
                out = [one(t, o) for t, o in zip(texts[begin:end], earlier, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(begin, end - begin), pa.array(out, before.type)], names=["row", "out"]
                )

    return run


def digest(found: DataFrame) -> DataFrame:
    """One row per document with counts of words and items."""
    n_hit = F.aggregate(
        "out.spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["first"]
    )
    return found.select(
        "row.doc_id",
        "out.n_words",
        n_hit.alias("n_hit"),
        F.size("out.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("out.items", ","), 256).alias("items_sha256"),
        (F.size("out.spans") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with their columns."""
    return occurrences(docs, benchmark, window).filter(F.size("out.spans") == 0).select("row.*")
