"""Best-fit packing of token sequences after Martello-Toth dominance reduction.

Documents are cut into pieces of ``CAPACITY`` tokens at most (only longer ones). Packing depends on lengths
alone, so the instance is the histogram of piece lengths: ``CAPACITY`` numbers, however many pieces there
are. On it the driver

1. fixes sets that dominate every other choice: the longest length with nothing that fits beside it; with
   a partner that fills the sequence exactly; or with its largest fitting partner where no third piece can
   fit. All pieces of a length go at once. This shrinks the instance and is repeated until nothing changes.
2. packs what is left best-fit, longest first, whole groups of equally filled sequences at a time.

The plan says which ranks of each length go to which sequences and places; its size depends on the number
of lengths. Ranks within a length are numbered in buckets of about ``BUCKET`` rows, so that a length which
most pieces have is ranked by many tasks.

Edge cases: NULL and empty texts are a piece of the end id alone. Repeated rows are packed each for itself.
An empty table gives no row and no sequence.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructType

from gridmart.llm.rows import map_texts
from gridmart.llm.tables import keep
from gridmart.llm.tokens import encoder

CAPACITY = 2048
BUCKET = 100_000

#: Equal sequences: lengths with how often each is in one, and the number of such sequences.
Pattern = tuple[tuple[tuple[int, int], ...], int]


def dominating(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Sequences fixed by dominance, and the histogram that is left."""
    left = Counter({length: n for length, n in counts.items() if n > 0})
    fixed: list[Pattern] = []
    changed = True
    while changed:
        changed = False
        lengths = sorted(left)
        for length in reversed(lengths):
            while left[length]:
                partner = _partner(left, lengths, length, capacity)
                if partner is None:
                    fixed.append((((length, 1),), left[length]))
                    left[length] = 0
                elif length + partner == capacity or not _third_fits(left, lengths, length, capacity):
                    if partner == length:
                        n = left[length] // 2
                        fixed.append((((length, 2),), n))
                        left[length] -= 2 * n
                    else:
                        n = min(left[length], left[partner])
                        fixed.append((((length, 1), (partner, 1)), n))
                        left[length] -= n
                        left[partner] -= n
                else:
                    break
                changed = True
    return fixed, {length: n for length, n in left.items() if n}


def _partner(left: Counter, lengths: list[int], length: int, capacity: int) -> int | None:
    """The largest piece left that fits beside one of ``length``."""
    for at in range(bisect_left(lengths, capacity - length + 1) - 1, -1, -1):
        other = lengths[at]
        if left[other] > (other == length):
            return other
    return None


def _third_fits(left: Counter, lengths: list[int], length: int, capacity: int) -> bool:
    """Whether the two smallest others fit beside one of ``length``."""
    small: list[int] = []
    for other in lengths:
        small += [other] * min(2 - len(small), left[other] - (other == length))
        if len(small) == 2:
            return length + small[0] + small[1] <= capacity
    return False


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing over a histogram: groups of equally filled sequences move together."""
    groups: dict[int, list[Pattern]] = defaultdict(list)
    rooms: list[int] = []

    def put(room: int, pattern: Pattern) -> None:
        if not groups[room]:
            insort(rooms, room)
        groups[room].append(pattern)

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                content, have = groups[room].pop()
                if not groups[room]:
                    rooms.pop(at)
            else:
                room, content, have = capacity, (), n
            # As one by one: a sequence takes pieces of this length until none fits.
            each = min(room // length, n)
            used = min(have, n // each)
            n -= used * each
            put(room - each * length, (content + ((length, each),), used))
            if content and have > used:
                put(room, (content, have - used))
    return [p for patterns in groups.values() for p in patterns]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, sequence, number in each, place), by length and rank."""
    fixed, rest = dominating(counts, capacity)
    ranks: Counter = Counter()
    rows, sequence = [], 0
    for content, n in fixed + best_fit(rest, capacity):
        place = 0
        for length, each in content:
            rows.append((length, ranks[length], sequence, each, place))
            ranks[length] += n * each
            place += each * length
        sequence += n
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pieces(
    docs: DataFrame,
    vocabulary: str,
    end_id: int = 0,
    capacity: int = CAPACITY,
    text: str = "text",
    ids: bool = False,
) -> DataFrame:
    """``row`` and one row per piece: ``piece, start, length, ids_crc32`` and, if asked for, ``ids``."""
    end = end_id.to_bytes(4, "little")
    fields = "piece:int,start:bigint,length:bigint,ids_crc32:bigint" + ",ids:binary" * ids

    def make():
        tokens = encoder(vocabulary)

        def cut(text: bytes | None) -> list[dict]:
            raw = tokens.encode(text.decode() if text else None) + end
            found = []
            for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                own = raw[at : at + 4 * capacity]
                piece = dict(piece=k, start=at // 4, length=len(own) // 4, ids_crc32=zlib.crc32(own))
                found.append(piece | ({"ids": own} if ids else {}))
            return found

        return lambda texts: [[cut(t) for t in texts]]

    found = map_texts(docs, make, f"pieces array<struct<{fields}>>", text)
    return found.select("row", F.explode("out.pieces").alias("p")).select("row", "p.*")


def pack(cut: DataFrame, capacity: int = CAPACITY, bucket: int = BUCKET) -> DataFrame:
    """``cut`` (one row per piece, with ``doc_id, piece, length``) with ``sequence_id`` and ``offset``.

    ``cut`` is read several times: pass a stored table.
    """
    spark = cut.sparkSession
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    steps = spark.sparkContext.broadcast(plan(counts, capacity))
    buckets = spark.createDataFrame(
        [(length, -(-n // bucket)) for length, n in counts.items()],
        "length bigint, _buckets bigint",
    )
    # One row per length.
    dealt = cut.join(F.broadcast(buckets), "length").withColumn(
        "_bucket", F.pmod(F.xxhash64("doc_id", "piece"), "_buckets")
    )
    by_length = Window.partitionBy("length").orderBy("_bucket")
    sizes = dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = by_length.rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece")
    ranked = (
        dealt.withColumn("_rank", F.row_number().over(within).cast("bigint") - 1)
        .join(sizes, ["length", "_bucket"])
        .select(*cut.columns, (F.col("_base") + F.col("_rank")).alias("_rank"))
    )

    def place(batches):
        rows = steps.value
        order = rows[:, 0] << np.int64(44) | rows[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            step = rows[np.searchsorted(order, length << np.int64(44) | rank, side="right") - 1]
            rank = rank - step[:, 1]
            sequence = step[:, 2] + rank // step[:, 3]
            offset = step[:, 4] + rank % step[:, 3] * length
            kept = [c for c in batch.schema.names if c != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(sequence), pa.array(offset)],
                names=[*kept, "sequence_id", "offset"],
            )

    schema = StructType(cut.schema.fields).add("sequence_id", LongType()).add("offset", LongType())
    return ranked.mapInArrow(place, schema)


def packed(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """Pieces of all documents with their sequence and place; ids stay out, their checksum is kept."""
    cut = pieces(docs.select("doc_id", text), vocabulary, text=text)
    cut = cut.select(F.col("row.doc_id").alias("doc_id"), "piece", "start", "length", "ids_crc32")
    return pack(keep(cut, "pieces"))
