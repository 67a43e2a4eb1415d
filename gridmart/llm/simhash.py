"""SimHash fingerprints of whole texts, with DataFrame functions only.

Terms are words (weight 1) and pairs of neighbouring words (weight 2). Each term's 64-bit hash votes with its weight
for its one bits and against the others; a fingerprint has the bits whose votes are over half of all. Two bits share a
64-bit sum (32 bits each), so a text may have a billion words. Words are exploded and summed up in the
same task, nothing but the text itself is shuffled.

``within_radius`` finds all fingerprints at most ``radius`` bits apart by permuted block tables: of ``blocks`` blocks two
such fingerprints agree on ``blocks - radius`` at least, so for every choice of so many blocks there is a table keyed by
them, and only fingerprints with equal keys are compared. Equal fingerprints are one class and never meet as pairs.

Edge cases: NULL texts are empty; texts without words have the fingerprint 0. Rows with a NULL id come first; rows of
the same id are ordered by their text. A single document is its own next. An empty table gives no row.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridmart.operators.quantiles import add_buckets, bucket_limits

RADIUS = 3
BLOCKS = 6
PAIR_WEIGHT = 2

_FIELDS = 0x0000000100000001
_LOW = 0xFFFFFFFF
_FIRST_KEY = -(1 << 63)


def in_order(docs: DataFrame, text: str = "text") -> DataFrame:
    """``bucket, place, doc_id, text, following, extra``: each text with the next one by ascending id.

    Buckets are ranges of ids with about as many rows each; a bucket also gets a copy (``extra``) of the first row
    of the next one, and the last bucket that of the first. Texts are shuffled once, by bucket.
    """
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_FIRST_KEY))
    keyed = docs.select(
        key.alias("key"), "doc_id", F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    limits = bucket_limits(keyed, "key", buckets)
    placed = add_buckets(keyed, [], "key", buckets, limits)
    ids = add_buckets(keyed.select("key"), [], "key", buckets, limits)
    # One row per bucket from here.
    firsts = ids.groupBy("bucket").agg(F.min("key").alias("least"))
    everything = Window.orderBy("bucket")
    last = F.max("bucket").over(Window.partitionBy(F.lit(0)))
    before = firsts.select(
        F.col("bucket").alias("own"),
        "least",
        F.coalesce(F.lag("bucket").over(everything), last).alias("before"),
    )
    copy = F.when(F.col("key") == F.col("least"), F.struct(F.col("before").alias("bucket"), F.lit(True).alias("extra")))
    mine = F.struct(F.col("bucket"), F.lit(False).alias("extra"))
    dealt = placed.join(F.broadcast(before), F.col("bucket") == F.col("own")).select(
        "key", "doc_id", "text", F.inline(F.array_compact(F.array(mine, copy)))
    )
    order = Window.partitionBy("bucket").orderBy("extra", "key", "text")
    return dealt.select(
        "bucket",
        F.row_number().over(order).alias("place"),
        "doc_id",
        "text",
        F.lead("text").over(order).alias("following"),
        "extra",
    )


def with_edited(ordered: DataFrame) -> DataFrame:
    """Adds ``edited``: the second half of the text replaced by the beginning of the next one."""
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    kept = F.substring("text", F.lit(1), n - half)
    return ordered.withColumn(
        "edited", F.concat(kept, F.substring(F.coalesce("following", F.lit("")), F.lit(1), half))
    )


def _votes(word: Column, following: Column) -> dict[str, Column]:
    """Sums over the terms of a text: all weights, and for each k the weights for bits k and k + 32."""
    one = F.xxhash64(word)
    pair = F.when(following.isNotNull(), F.xxhash64(word, following))
    sums = {"total": F.sum(F.lit(1) + F.when(following.isNotNull(), PAIR_WEIGHT).otherwise(0))}
    for k in range(32):
        single = F.shiftrightunsigned(one, k).bitwiseAND(_FIELDS)
        double = F.shiftrightunsigned(pair, k).bitwiseAND(_FIELDS) * PAIR_WEIGHT
        sums[f"s{k}"] = F.sum(single + F.coalesce(double, F.lit(0)))
    return sums


def _bits() -> Column:
    """The fingerprint of the sums as a number."""
    total = F.col("total")
    bits = F.lit(0).cast("bigint")
    for k in range(32):
        low = F.col(f"s{k}").bitwiseAND(_LOW)
        high = F.shiftrightunsigned(f"s{k}", 32)
        bits = bits + F.when(low * 2 > total, F.lit(1 << k)).otherwise(F.lit(0))
        value = (1 << (k + 32)) - (1 << 64) * (k == 31)
        bits = bits + F.when(high * 2 > total, F.lit(value)).otherwise(F.lit(0))
    return bits


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and ``bits``, a 64-bit number, for texts that have words."""
    words = F.array_remove(F.split(text, "[\\x20\\t-\\r]+"), "")
    listed = texts.select(*keys, words.alias("w")).filter(F.size("w") > 0)
    pairs = listed.select(*keys, F.inline(F.arrays_zip("w", F.expr("slice(w, 2, size(w))").alias("v"))).alias("w", "v"))
    votes = _votes(F.col("w"), F.col("v"))
    summed = pairs.groupBy(*keys).agg(*[v.alias(name) for name, v in votes.items()])
    return summed.select(*keys, _bits().alias("bits"))


def hexadecimal(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def compared(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every document's fingerprint beside those of its edited text and of the next document."""
    ordered = with_edited(in_order(docs, text))
    both = ordered.select(
        "bucket",
        "place",
        F.inline(
            F.array(
                F.struct(F.lit(False).alias("is_edited"), F.col("text").alias("body")),
                F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("body")),
            )
        ),
    )
    found = fingerprints(both, ["bucket", "place", "is_edited"], "body")
    of_row = found.groupBy("bucket", "place").agg(
        F.max(F.when(~F.col("is_edited"), F.col("bits"))).alias("own"),
        F.max(F.when(F.col("is_edited"), F.col("bits"))).alias("changed"),
    )
    known = ordered.select(
        "bucket",
        "place",
        "doc_id",
        "extra",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
    )
    zero = F.lit(0).cast("bigint")
    order = Window.partitionBy("bucket").orderBy("place")
    return (
        known.join(of_row, ["bucket", "place"], "left")
        .withColumns({"own": F.coalesce("own", zero), "changed": F.coalesce("changed", zero)})
        .withColumn("next", F.lead("own").over(order))
        .filter(~F.col("extra"))
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            hexadecimal(F.col("own")).alias("fingerprint"),
            hexadecimal(F.col("changed")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("changed")).alias("near_edited"),
            likeness(F.col("own"), F.col("next")).alias("near_next"),
        )
    )


def within_radius(
    found: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS
) -> tuple[DataFrame, DataFrame]:
    """Of ``id, bits``: the classes ``id, class_id`` and the pairs ``a, b, distance`` of class ids.

    A class holds the ids of one fingerprint. Pairs are classes at most ``radius`` bits apart, each once.
    """
    if not 0 <= radius < blocks:
        raise ValueError("more blocks than the radius are needed")
    by_bits = found.groupBy("bits").agg(F.min("id").alias("class_id"))
    classes = found.join(by_bits, "bits").select("id", "class_id")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [sum(1 << bit for bit in range(edges[i], edges[i + 1])) for i in range(blocks)]
    tables = []
    for chosen in combinations(range(blocks), blocks - radius):
        mask = sum(masks[i] for i in chosen)
        tables.append(mask - (1 << 64) * (mask >= 1 << 63))
    posted = by_bits.select(
        "class_id", "bits", F.posexplode(F.array(*[F.col("bits").bitwiseAND(m) for m in tables]))
    )
    left = posted.select("pos", "col", F.col("class_id").alias("a"), F.col("bits").alias("x"))
    right = posted.select("pos", "col", F.col("class_id").alias("b"), F.col("bits").alias("y"))
    distance = F.bit_count(F.col("x").bitwiseXOR(F.col("y")))
    pairs = (
        left.join(right, ["pos", "col"])
        .filter((F.col("a") < F.col("b")) & (distance <= radius))
        .select("a", "b", distance.alias("distance"))
        .distinct()
    )
    return classes, pairs
