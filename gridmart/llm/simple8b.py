"""Token-ID files in word-aligned Simple-8b coding.

A 64-bit word holds a selector in its top four bits and, in the 60 bits below, as many ids as the
selector says, all of one width. In every width the value of all ones is an escape: the id stands in the
block's list of escapes, in order. Ids too large for the widest selector are escapes.

A file set is a Parquet table with one row per block: ``shard`` (ascending ids), ``block``, ``first`` (ids
of the shard before the block), ``n_ids``, ``doc_ids``, ``stops`` (where each document's ids end within the
block), ``words`` and ``escapes`` (little-endian). Blocks hold whole documents, ``BLOCK_IDS`` ids or more each but
for a shard's last. All words of a block are decoded at once: the counts of the selectors tell where the
ids of each word go.

Edge cases: NULL and empty texts have the end id alone. Rows with a NULL id come first; rows with the same
id are ordered by their text and each keeps its own ids. An empty table gives no block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gridmart.llm.tokens import encoder
from gridmart.llm.words import texts_of

BLOCK_IDS = 1 << 15

#: (ids in a word, bits of each) by selector.
SELECTORS = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15)]
_COUNTS = np.array([n for n, _ in SELECTORS])
_LARGEST = (1 << SELECTORS[-1][1]) - 2
_WIDTHS = np.array([b for _, b in SELECTORS])
#: Selector that the value needs at least, for values that are no escapes.
_NEEDS = np.searchsorted((1 << _WIDTHS) - 1, np.arange(_LARGEST + 1), side="right").astype(np.int8)

FORMAT = """shard int, block int, first bigint, n_ids bigint, doc_ids array<bigint>, stops array<bigint>,
words binary, escapes binary"""


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and escapes of ``ids`` (unsigned, 32 bits)."""
    n = len(ids)
    if not n:
        return np.zeros(0, "<u8"), np.zeros(0, "<u4")
    large = ids > _LARGEST
    needs = np.where(large, 0, _NEEDS[np.where(large, 0, ids)])
    # From each place: the narrowest selector whose whole word fits, or ends the block. Runs of ids that
    # fit a selector lie between those that do not.
    chosen = np.full(n, len(SELECTORS) - 1, dtype=np.int8)
    for s in range(len(SELECTORS) - 2, -1, -1):
        bad = np.flatnonzero(needs > s)
        if not len(bad):
            chosen[:] = s
            continue
        chosen[bad[-1] + 1 :] = s
        run = np.diff(bad, prepend=-1) - SELECTORS[s][0]
        long = run > 0
        length, stop = run[long], bad[long] - SELECTORS[s][0] + 1
        cells = np.repeat(stop - np.cumsum(length), length) + np.arange(length.sum())
        chosen[cells] = s
    steps = _COUNTS[chosen].tolist()
    places, i = [], 0
    while i < n:
        places.append(i)
        i += steps[i]
    begins = np.array(places)
    selectors = chosen[begins]
    padded = np.concatenate([np.where(large, 0, ids), np.zeros(60, ids.dtype)]).astype(np.uint64)
    escaped = np.concatenate([large, np.zeros(60, dtype=bool)])
    words = selectors.astype(np.uint64) << np.uint64(60)
    for s, (count, bits) in enumerate(SELECTORS):
        own = np.flatnonzero(selectors == s)
        if len(own):
            cells = begins[own][:, None] + np.arange(count)
            values = padded[cells]
            values[escaped[cells]] = (1 << bits) - 1
            values <<= (np.arange(count) * bits).astype(np.uint64)
            words[own] |= np.bitwise_or.reduce(values, axis=1)
    return words.astype("<u8"), ids[large].astype("<u4")


def unpack(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of a block."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = _COUNTS[selectors] if len(words) else np.zeros(0, dtype=np.int64)
    begins = np.cumsum(counts) - counts
    size = int(counts.sum())
    out, marked = np.zeros(size, dtype=np.uint32), np.zeros(size, dtype=bool)
    for s, (count, bits) in enumerate(SELECTORS):
        own = np.flatnonzero(selectors == s)
        if len(own):
            ones = np.uint64((1 << bits) - 1)
            shifts = (np.arange(count) * bits).astype(np.uint64)
            values = (words[own][:, None] >> shifts) & ones
            cells = begins[own][:, None] + np.arange(count)
            out[cells] = values
            marked[cells] = values == ones
    out = out[:n]
    out[np.flatnonzero(marked[:n])] = escapes
    return out


def _blocks(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("shard", pa.int32()),
                ("block", pa.int32()),
                ("first", pa.int64()),
                ("n_ids", pa.int64()),
                ("doc_ids", pa.list_(pa.int64())),
                ("stops", pa.list_(pa.int64())),
                ("words", pa.binary()),
                ("escapes", pa.binary()),
            ]
        )
        shard, tokens, end = TaskContext.get().partitionId(), encoder(path), end_id.to_bytes(4, "little")
        block = first = size = 0
        docs: list = []
        stops: list[int] = []
        parts: list[bytes] = []

        def close():
            ids = np.frombuffer(b"".join(parts), dtype="<u4")
            words, escapes = pack(ids)
            row = [shard, block, first, size, list(docs), list(stops), words.tobytes(), escapes.tobytes()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], type=f.type) for v, f in zip(row, schema, strict=True)], schema=schema
            )

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                ids = tokens.encode(text.decode() if text else None) + end
                size += len(ids) // 4
                docs.append(doc)
                stops.append(size)
                parts.append(ids)
                if size >= BLOCK_IDS:
                    yield close()
                    block, first, size = block + 1, first + size, 0
                    docs, stops, parts = [], [], []
        if docs:
            yield close()

    return run


def write(
    docs: DataFrame, path: str, vocabulary: str, end_id: int = 0, text: str = "text", shards: int = 0
) -> None:
    """Encode all documents, ascending by ``doc_id``, and write them as a file set to ``path``."""
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        docs.select(F.col("doc_id").cast("bigint"), F.col(text).cast("string"))
        .repartitionByRange(shards, "doc_id")
        .sortWithinPartitions("doc_id", text)
        .mapInArrow(_blocks(vocabulary, end_id), FORMAT)
        .write.parquet(path)
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            words = np.frombuffer(row["words"], dtype="<u8")
            escapes = np.frombuffer(row["escapes"], dtype="<u4")
            raw = unpack(words, escapes, row["n_ids"]).astype("<u4").tobytes()
            stops = np.array(row["stops"], dtype=np.int64)
            begins = np.concatenate(([0], stops[:-1]))
            ids = [raw[4 * a : 4 * b] for a, b in zip(begins, stops, strict=True)]
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, row["shard"], dtype=np.int32)),
                    pa.array(row["doc_ids"], type=pa.int64()),
                    pa.array(begins + row["first"]),
                    pa.array(stops - begins),
                    pa.array([zlib.crc32(i) for i in ids], type=pa.int64()),
                    pa.array(ids, type=pa.binary()),
                ],
                names=["shard", "doc_id", "place", "n_tokens", "ids_crc32", "ids"],
            )


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, ids`` decoded from a file set.

    A document's place in its shard stands in the file; sizes of the shards (one row each) are summed up
    and broadcast to give its place in the whole.
    """
    blocks = spark.read.schema(FORMAT).parquet(path)
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("size"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    documents = blocks.mapInArrow(
        _read,
        "shard int, doc_id bigint, place bigint, n_tokens bigint, ids_crc32 bigint, ids binary",
    )
    return documents.join(F.broadcast(starts), "shard").select(
        "doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )
