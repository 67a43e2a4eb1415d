"""Removal of passages that stand in an earlier document, by level-wise doubling.

A passage is a window of ``WINDOW`` words whose sequence also starts in a document with a smaller id. Windows are looked at
by lengths that double: 7, 13, 25 and 50 words for a window of 50.

* Of the shortest pieces inside each window only the one with the smallest hash is posted, its anchor (winnowing): equal
  windows have equal anchors, so nothing is lost, and one posting stands for some twenty windows. Neighbouring windows
  with the same anchor form a block. Anchors of a single document drop out.
* A block with the words of an earlier document's block is a repeat as a whole. Only the earliest block of each
  content goes on, and only where its anchor stands in blocks of different contents.
* Each window of these is extended from its anchor to about twice the length, as far as it reaches into the window and else to the
  left; pieces of that length that only one document has end their windows. So on, level by level, until the
  whole window is compared, or no candidate survives.

Equality of blocks, pieces and windows is that of two 61-bit polynomial hashes with independent bases over 64-bit hashes of words.

Hot passages: each task drops blocks that it has seen in an earlier document of the same slice before
anything is shuffled; from then on every step is a grouped minimum, combined before the shuffle, and a join with it, which
AQE may split. No step gathers more than one document's findings in a row.

Disk: every step is stored; its shuffles, and the tables that only led to it, are deleted then.

Edge cases: NULL and empty texts have no words. Texts shorter than the window are left alone. Rows with a
NULL id are left alone and are no source. Rows with the same id don't cut each other, whatever their texts.
Repeats inside one document stay, unless an earlier one has them. Columns of any name pass through.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from gridmart.llm.tables import keep_alone
from gridmart.llm.words import Words, mix, slices, span_hashes, split, texts_of, windows
from gridmart.session import discard

WINDOW = 50

_SPAN = pa.struct([("first", pa.int32()), ("n", pa.int32())])
_BLOCK = [("first", pa.int32()), ("n", pa.int32()), ("anchored", pa.int32())]
POSTING = pa.schema(
    [
        ("late", pa.bool_()),
        ("anchor", pa.int64()),
        ("block", pa.int64()),
        ("block2", pa.int64()),
        ("doc_id", pa.int64()),
        ("tag", pa.int64()),
        *_BLOCK,
    ]
)
PIECE = pa.schema(
    [
        ("_id", pa.int64()),
        ("_tag", pa.int64()),
        ("first", pa.int32()),
        ("low", pa.int32()),
        ("high", pa.int32()),
        ("hash", pa.int64()),
        ("hash2", pa.int64()),
    ]
)
RESULT = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("kept_sha256", pa.string()),
        ("kept", pa.string()),
    ]
)
PENDING = pa.struct(
    [
        ("text", pa.binary()),
        ("sure", pa.list_(_SPAN)),
        ("open", pa.list_(pa.struct([*_BLOCK, ("words", pa.binary())]))),
    ]
)


def _spark(schema: pa.Schema) -> StructType:
    return from_arrow_schema(schema, prefer_timestamp_ntz=False)


def smallest_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Where the first smallest of each ``width`` consecutive values is."""
    at = np.arange(len(values))
    size = 1
    while size < width:
        step = min(size, width - size)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(values[left] <= values[right], left, right)
        size += step
    return at


def levels(window: int, least: int = 7) -> list[int]:
    """Lengths up to the window, each about twice the one before."""
    found = [window]
    while found[0] > least:
        found.insert(0, (found[0] + 1) // 2)
    return found


def blocks_of(words: Words, window: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, two block hashes, document, first word (in the document), number of windows, and words from
    the block's first to its anchor."""
    empty = (np.zeros(0, np.uint64),) * 3 + (np.zeros(0, np.int64),) * 4
    shortest = levels(window)[0]
    counts = words.counts()
    starts = np.maximum(counts - window + 1, 0)
    if not starts.sum():
        return empty
    pieces = words.windows(shortest)
    anchors = smallest_in_windows(pieces, window - shortest + 1)
    doc = np.repeat(np.arange(len(counts)), starts)
    within = np.arange(len(doc)) - np.repeat(np.cumsum(starts) - starts, starts)
    at = words.first[doc] + within
    anchor = anchors[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(new)
    n = np.diff(np.append(begin, len(at)))
    first, place = at[begin], anchor[begin]
    # The place of the anchor follows from the content but for repeats inside it.
    apart = mix((place - first).astype(np.uint64))
    contents = [span_hashes(words.hashes, first, first + n - 1 + window, base) ^ apart for base in (0, 1)]
    return pieces[place], *contents, doc[begin], within[begin], n, place - first


def _post(window: int):
    """Blocks of all documents; ``late`` ones repeat an earlier document of the same slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = POSTING
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(), texts_of(batch.column(1))
            for begin, end in slices(texts):
                own = texts[begin:end]
                tags = np.array([zlib.crc32(t or b"") for t in own], dtype=np.int64)
                anchor, block, block2, doc, first, n, anchored = blocks_of(split(own), window)
                ids_here = ids[begin:end][doc]
                order = np.lexsort((ids_here, block2, block, anchor))
                a, b, b2, d = anchor[order], block[order], block2[order], ids_here[order]
                new = np.ones(len(order), dtype=bool)
                new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (b2[1:] != b2[:-1])
                late = np.zeros(len(order), dtype=bool)
                if len(order):
                    late[order] = d > d[np.flatnonzero(new)][np.cumsum(new) - 1]
                hashes = (h.view(np.int64) for h in (anchor, block, block2))
                columns = [late, *hashes, ids_here, tags[doc], first, n, anchored]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c).cast(f.type) for c, f in zip(columns, schema, strict=True)],
                    schema=schema,
                )

    return run


def _findings(postings: DataFrame, made: list[str]) -> DataFrame:
    """Blocks that repeat an earlier document, and ``open`` ones, whose windows are still to be compared.

    ``made`` gets the folders that they are read from.
    """
    kept = ["doc_id", "tag", "first", "n", "anchored"]
    here = postings.filter("NOT late").drop("late")
    shared = here.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a < b")
    # Stored, so that AQE may split a hot anchor: it does not where a join reads a grouping. Anchors grow with the
    # corpus, so it is the same shuffle join at every size.
    shared = keep_alone(shared.select("anchor"), "shared-anchors", made)
    left = keep_alone(here.join(shared.hint("merge"), "anchor", "left_semi"), "shared-blocks", made)
    contents = left.groupBy("anchor", "block", "block2").agg(F.min("doc_id").alias("earliest"))
    several = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("contents")).filter("contents > 1")
    known = contents.join(several, "anchor", "left").select("anchor", "block", "block2", "earliest", "contents")
    known = keep_alone(known, "contents", made)
    told = left.join(known, ["anchor", "block", "block2"])
    late = F.col("doc_id") > F.col("earliest")
    told = told.filter(late | F.col("contents").isNotNull()).select(*kept, (~late).alias("open"))
    return told.unionByName(postings.filter("late").select(*kept, F.lit(False).alias("open")))


def _remove(text: bytes, covered: list[tuple[int, int]], window: int) -> tuple[int, int, bytes]:
    """Number of words, of removed ones, and the kept ones joined by a space."""
    words = text.split()
    gone = np.zeros(len(words), dtype=bool)
    for first, n in covered:
        gone[first : first + n - 1 + window] = True
    kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if covered else words
    return len(words), len(words) - len(kept), b" ".join(kept)


def _result(text: bytes, covered: list[tuple[int, int]], window: int, texts: bool) -> dict:
    n_words, n_removed, kept = _remove(text, covered, window)
    return dict(
        n_words=n_words,
        n_removed=n_removed,
        kept_sha256=hashlib.sha256(kept).hexdigest(),
        kept=kept.decode("utf-8", "replace") if texts and n_removed else None,
    )


def _settle(window: int, texts: bool):
    """Results of documents without open blocks; for the others these blocks, with hashes of their words."""

    def one(text: bytes | None, found: list[dict] | None) -> tuple[dict | None, dict | None]:
        text, found = text or b"", found or []
        sure = [(f["first"], f["n"]) for f in found if not f["open"]]
        opened = [f for f in found if f["open"]]
        if not opened:
            return _result(text, sure, window, texts), None
        hashes = split([text]).hashes
        for f in opened:
            f["words"] = hashes[f["first"] : f["first"] + f["n"] - 1 + window].tobytes()
        return None, dict(text=text, sure=[{"first": a, "n": n} for a, n in sure], open=opened)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body = texts_of(batch.column("_text"))
            for begin, end in slices(body):
                part = batch.slice(begin, end - begin)
                found = part.column("_found").to_pylist()
                pairs = [one(t, f) for t, f in zip(body[begin:end], found, strict=True)]
                results, pending = zip(*pairs, strict=True)
                made = [pa.array(results, RESULT), pa.array(pending, PENDING)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("_id"), part.column("_tag"), *made],
                    names=["row", "_id", "_tag", "result", "pending"],
                )

    return run


def _pieces(window: int, length: int):
    """The pieces of one length of a block's windows that are still alive, with the windows that share each.

    A window's piece starts at the anchor, or as far to the left as it must to lie in the window. Windows whose piece
    starts at the anchor are neighbours and have had the same fate before; the others have a piece of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column("words").to_pylist()
            sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) // 8
            begins = np.cumsum(sizes) - sizes
            hashes = np.frombuffer(b"".join(words), dtype=np.uint64)
            alive = batch.column("alive")
            low, high = (alive.flatten().field(i).to_numpy().astype(np.int64) for i in (0, 1))
            block = np.repeat(np.arange(len(words)), alive.value_lengths().to_numpy())
            # Every window of every range, then its piece.
            number = high - low + 1
            start = np.repeat(low - np.cumsum(number) + number, number) + np.arange(number.sum())
            block = np.repeat(block, number)
            anchored = batch.column("anchored").to_numpy().astype(np.int64)[block]
            place = np.minimum(anchored, start + window - length)
            order = np.lexsort((start, block))
            block, start, place = block[order], start[order], place[order]
            new = np.ones(len(block), dtype=bool)
            new[1:] = (block[1:] != block[:-1]) | (place[1:] != place[:-1])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(block)) - 1
            own, at = block[first], begins[block[first]] + place[first]
            keys = [batch.column(c).take(pa.array(own)) for c in ("_id", "_tag", "first")]
            found = [windows(hashes, length, base)[at].view(np.int64) for base in (0, 1)]
            bounds = [start[first].astype(np.int32), start[last].astype(np.int32)]
            columns = [*keys, *map(pa.array, [*bounds, *found])]
            yield pa.RecordBatch.from_arrays(columns, schema=PIECE)

    return run


def _repeated_windows(blocks: DataFrame, window: int, made: list[str]) -> DataFrame:
    """``_id, _tag, place`` of each window of open blocks that an earlier document has, level by level.

    ``made`` has the folder of the blocks; it goes when what is left of them is stored.
    """
    key = ["_id", "_tag", "first"]
    whole = F.array(F.struct(F.lit(0).alias("low"), (F.col("n") - 1).alias("high")))
    alive = blocks.dropDuplicates(key).withColumn("alive", whole)
    for length in levels(window)[1:] or [window]:
        pieces = alive.mapInArrow(_pieces(window, length), _spark(PIECE))
        repeated = (
            pieces.groupBy("hash", "hash2")
            .agg(F.min("_id").alias("earliest"), F.max("_id").alias("latest"))
            .filter("earliest < latest")
        )
        left = pieces.join(repeated, ["hash", "hash2"])
        if length == window:
            break
        ranges = left.groupBy(*key).agg(F.collect_list(F.struct("low", "high")).alias("alive"))
        before = made.copy()
        alive = keep_alone(alive.drop("alive").join(ranges, key), "alive-blocks", made)
        if alive.isEmpty():
            break
        discard(alive.sparkSession, before)
        del made[: len(before)]
    late = left.filter(F.col("_id") > F.col("earliest")) if length == window else left.filter(F.lit(False))
    return late.select("_id", "_tag", F.explode(F.sequence("low", "high")).alias("start"), "first").select(
        "_id", "_tag", (F.col("first") + F.col("start")).alias("place")
    )


def _finish(window: int, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            columns = (batch.column(c).to_pylist() for c in ("text", "sure", "_late"))
            for text, sure, late in zip(*columns, strict=True):
                covered = [(s["first"], s["n"]) for s in sure] + [(p, 1) for p in late or ()]
                made.append(_result(text, covered, window, texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(made, RESULT)], names=["row", "result"]
            )

    return run


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, text: str = "text", texts: bool = True
) -> DataFrame:
    """``row`` (the document; without ``texts`` its id alone) and ``result``.

    ``result.kept`` is the text that is left, NULL where nothing was removed.
    """
    made: list[str] = []
    key = F.col("doc_id").cast("bigint")
    posted = docs.select(key, F.col(text).cast("string")).filter(F.col("doc_id").isNotNull())
    postings = keep_alone(posted.mapInArrow(_post(window), _spark(POSTING)), "blocks", made)
    found = _findings(postings, made)
    # One document's blocks.
    by_doc = found.groupBy(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag")).agg(
        F.collect_list(F.struct("first", "n", "anchored", "open")).alias("_found")
    )
    row = F.struct("*") if texts else F.struct("doc_id")
    body = F.col(text).cast("string")
    keyed = docs.select(
        row.alias("row"),
        body.alias("_text"),
        key.alias("_id"),
        F.crc32(F.coalesce(body, F.lit("")).cast("binary")).alias("_tag"),
    )
    joined = keyed.join(by_doc, ["_id", "_tag"], "left")
    results = _spark(pa.schema([("result", RESULT), ("pending", PENDING)])).fields
    settled_type = StructType(keyed.select("row", "_id", "_tag").schema.fields + results)
    settled = keep_alone(
        joined.select("row", "_id", "_tag", "_text", "_found").mapInArrow(
            _settle(window, texts), settled_type
        ),
        "settled",
        [],
    )
    discard(docs.sparkSession, made)
    left = settled.filter("pending IS NOT NULL").select("row", "_id", "_tag", "pending.*")
    made = []
    blocks = keep_alone(left.select("_id", "_tag", F.inline("open")), "open-blocks", made)
    late = _repeated_windows(blocks, window, made).groupBy("_id", "_tag").agg(F.collect_list("place").alias("_late"))
    finished = (
        left.select("row", "_id", "_tag", "text", "sure")
        .join(late, ["_id", "_tag"], "left")
        .select("row", "text", "sure", "_late")
        .mapInArrow(
            _finish(window, texts), StructType([keyed.schema["row"], results[0]])
        )
    )
    return settled.filter("pending IS NULL").select("row", "result").unionByName(finished)


def digest(removed: DataFrame) -> DataFrame:
    return removed.select("row.doc_id", "result.n_words", "result.n_removed", "result.kept_sha256")


def shortened(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """All documents, with what is left of their text; ``n_chars`` follows where there is one."""
    whole = remove_repeats(docs, window)
    kept, kind = F.col("result.kept"), docs.schema["text"].dataType
    changes = [F.coalesce(kept, F.col("row.text").cast("string")).cast(kind).alias("text")]
    if "n_chars" in docs.columns:
        length = F.length(kept).cast(docs.schema["n_chars"].dataType)
        changes.append(F.when(kept.isNotNull(), length).otherwise(F.col("row.n_chars")).alias("n_chars"))
    # Fields of the row in their order, whatever their names.
    changed = {c: change for c, change in zip(("text", "n_chars"), changes)}
    return whole.select(
        *(changed.get(c, F.col("row").getField(c).alias(c)) for c in docs.columns)
    )
