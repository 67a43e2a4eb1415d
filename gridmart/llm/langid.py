"""Language identification by compression.

For each language a raw-content zstandard dictionary is cut from its training texts. A text, lower-cased
and with all ASCII but letters made spaces, is compressed in blocks of ``BLOCK`` bytes, whole, with each
dictionary; the language whose dictionary leaves the fewest bytes wins. A dictionary only helps near the
start of what is compressed, hence the blocks. Where the next best is closer than ``MIN_MARGIN`` (of its
size) the text is rejected, as is one without letters, which is ``und``.

Fit: at most ``SAMPLE_TEXTS`` different texts per language, those with the smallest hash of the text (copies take
one place together), ``SAMPLE_BYTES`` in total (documented bound: languages x 48 KiB on the driver; more than
``MAX_LANGUAGES`` languages are an error). Room that short texts leave goes to the longer ones. Of a text longer than its
part, spans are learned at places that its hash chooses, one in each of as many equal stretches. Numbers of training rows are counted over all of them. Prediction covers every
text whole, and shuffles nothing.

Edge cases: NULL, empty and letterless texts are ``und``, score 0, rejected. Ties go to the language with
more training rows, then to the one first in order. Rows with a NULL language or text are not learned from. Without any training row all are ``und``.
Repeated rows get equal results.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from gridmart.llm.rows import map_texts
from gridmart.llm.tables import held_out, keep
from gridmart.llm.words import texts_of

SAMPLE_TEXTS = 64
SAMPLE_BYTES = 48 << 10
#: Of a text longer than its part, spans of this size at most.
SPAN_BYTES = SAMPLE_BYTES // SAMPLE_TEXTS
MAX_LANGUAGES = 1000
BLOCK = 2048
LEVEL = 6
MIN_MARGIN = 0.02

_LETTER = re.compile(r"[^\W\d_]")
#: bytes.translate table: ASCII but a-z to a space.
_LETTERS_ONLY = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def plain(text: str) -> bytes:
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_LETTERS_ONLY).split())


def _sampled(learn: DataFrame) -> DataFrame:
    """``lang, place, hash, text``: the different texts of each language that are learned from."""
    hashed = learn.withColumn("hash", F.xxhash64("text"))
    # Only hashes and keys are shuffled, one row per different text of a task.
    texts = hashed.groupBy("lang", "hash").agg(F.min("key").alias("key"))
    # A rank limit: each task passes on SAMPLE_TEXTS rows of a language at most.
    by = Window.partitionBy("lang").orderBy("hash")
    places = texts.withColumn("place", F.row_number().over(by)).filter(F.col("place") <= SAMPLE_TEXTS)
    # SAMPLE_TEXTS rows per language; rows that repeat a key with its text count once.
    chosen = hashed.join(F.broadcast(places), ["lang", "hash", "key"])
    return chosen.groupBy("lang", "place", "hash").agg(F.min("text").alias("text"))


def _bare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as they are compressed, with their sizes."""
    for batch in batches:
        bare = [plain(t.decode("utf-8", "replace")) for t in texts_of(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(bare, pa.binary()), pa.array(map(len, bare), pa.int64())],
            names=["lang", "place", "hash", "bare", "size"],
        )


def parts(sizes: list[int], room: int) -> list[int]:
    """How much of each text is learned: whole texts while they fit, else equal parts of what is left."""
    given = [0] * len(sizes)
    order = sorted(range(len(sizes)), key=sizes.__getitem__)
    for k, i in enumerate(order):
        given[i] = min(sizes[i], room // (len(order) - k))
        room -= given[i]
    return given


def spans(size: int, part: int, seed: int) -> list[tuple[int, int]]:
    """(first, stop) of what is learned of a text: one span in each of equal stretches of it."""
    if part >= size:
        return [(0, size)]
    number = -(-part // SPAN_BYTES)
    found = []
    for k in range(number):
        begin, end = size * k // number, size * (k + 1) // number
        length = part * (k + 1) // number - part * k // number - (k > 0)  # a space stands between
        first = begin + xxhash.xxh3_64_intdigest(f"{seed} {k}".encode()) % (end - begin - length + 1)
        found.append((first, first + length))
    return found


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> dict:
    """Raw content per language, the language with most training rows first."""
    learn = docs.select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.col(key).alias("key")
    ).filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("key")))
    counts = learn.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES + 1)
    order = [row["lang"] for row in counts.collect()]
    if len(order) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    # SAMPLE_TEXTS rows per language, with whole texts; the driver sees their sizes, then the spans it asks for.
    sampled = keep(
        _sampled(learn).mapInArrow(_bare, "lang string, place int, hash bigint, bare binary, size bigint"), "sampled"
    )
    listed: dict[str, list] = defaultdict(list)
    for row in sampled.select("lang", "place", "hash", "size").orderBy("lang", "place").collect():
        listed[row["lang"]].append(row)
    wanted = []
    for name, rows in listed.items():
        given = parts([r["size"] for r in rows], SAMPLE_BYTES - len(rows) + 1)
        for r, part in zip(rows, given, strict=True):
            wanted += [(name, r["place"], a, b - a) for a, b in spans(r["size"], part, r["hash"])]
    if not wanted:
        return {k: b"" for k in order}
    asked = docs.sparkSession.createDataFrame(wanted, "lang string, place int, first int, length int")
    pieces = (
        sampled.join(F.broadcast(asked), ["lang", "place"])
        .select("lang", "place", "first", F.substring("bare", F.col("first") + 1, F.col("length")).alias("piece"))
        .orderBy("lang", "place", "first")
    )
    found: dict[str, list] = defaultdict(list)
    for row in pieces.collect():
        found[row["lang"]].append(bytes(row["piece"]))
    return {k: b" ".join(found[k]) for k in order}


class Classifier:
    def __init__(self, contents: dict[str, bytes]):
        self.names = list(contents)
        self.compress = []
        for name in self.names:
            content = zstandard.ZstdCompressionDict(
                contents[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            content.precompute_compress(level=LEVEL)
            compressor = zstandard.ZstdCompressor(
                level=LEVEL, dict_data=content, write_content_size=False, write_dict_id=False
            )
            self.compress.append(compressor.compress)

    def predict(self, text: bytes | None) -> tuple[str, float, bool]:
        """Language, relative margin to the second best (0 to 1), and whether it is wide enough."""
        decoded = text.decode("utf-8", "replace") if text else ""
        if not self.names or not _LETTER.search(decoded):
            return "und", 0.0, False
        bare = plain(decoded)
        pieces = [bare[i : i + BLOCK] for i in range(0, len(bare), BLOCK)] or [b""]
        sizes = [sum(len(c(p)) for p in pieces) for c in self.compress]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        rest = sizes[:best] + sizes[best + 1 :]
        margin = (min(rest) - sizes[best]) / min(rest) if rest else 1.0
        return self.names[best], margin, margin >= MIN_MARGIN


def predict(docs: DataFrame, contents: dict[str, bytes], text: str = "text") -> DataFrame:
    """``row`` and ``out`` (lang_pred, score, accepted) for every document."""
    sent = docs.sparkSession.sparkContext.broadcast(contents)  # bounded by SAMPLE_BYTES per language

    def make():
        classifier = Classifier(sent.value)
        return lambda texts: list(zip(*(classifier.predict(t) for t in texts), strict=True))

    return map_texts(docs, make, "lang_pred string, score double, accepted boolean", text)


def digest(predicted: DataFrame) -> DataFrame:
    return predicted.select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "out.*"
    )


def accepted(docs: DataFrame) -> DataFrame:
    """The documents whose language is told with a sufficient margin, with their columns."""
    return predict(docs, fit(docs)).filter("out.accepted").select("row.*")
