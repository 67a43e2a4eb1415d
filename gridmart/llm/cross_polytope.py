"""Nearest neighbours by inner product: cross-polytope hashing with multiprobe tables and exact reranking.

* A vector is rotated at random by three rounds of sign flips and fast Hadamard transforms; its hash is the signed axis
  nearest to it. A table's key joins as many of these functions as are needed for about ``PER_BUCKET`` rows a
  bucket (the last one over fewer coordinates); there are ``TABLES`` tables. Every row is posted in each.
* A query looks into each table's ``probes`` best buckets, those with the largest sum of its coordinates along their axes.
  How many that are is measured: ``SAMPLE`` queries, picked by hash, are held against all rows, and the least number is
  taken that finds ``RECALL`` of their true neighbours. Beyond that bounded sample nothing is fitted.
* Every candidate of these buckets is scored exactly, in double precision on the original vectors.
* Where lengths differ, rows get one more coordinate that makes them equally long, so the largest inner product
  stands at the smallest angle.

Distribution: a table's buckets are dealt, in order, into shards of about ``SHARD`` rows; a query goes once to each shard that it
probes. Shards with more rows (near copies share buckets) are cut into blocks by a hash of the vector, and its queries go
to each of them. A task holds one block and streams queries past it, which leave their best there alone. Equal
vectors are one class: they always share a block, and of its ids only the ``count + 1`` smallest can ever be in
a result, as ties go to the smaller id; each batch of input keeps so many of them before the shuffle.

Edge cases: rows with a NULL id, and vectors that are NULL, empty, zero, or hold NULL or non-finite components, take no
part. A shorter vector counts as if zeros followed. Repeated rows count once; an id with several vectors has its best
score. A query never finds its own id. An empty table, or one without queries, gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from gridmart.operators.codes import small_side

TABLES = 3
PER_BUCKET = 256
RECALL = 0.97
SAMPLE = 256
SHARD = 16_384
#: Queries that are answered in one step.
STEP = 256
#: Buckets of a table that are put in order for a query; all, where a table has fewer.
ORDERED = 1 << 16
#: Shards (of three integers) whose sizes are broadcast; beyond, they are joined by a shuffle.
LISTED = 500_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal fast Hadamard transform of each row; their length is a power of two."""
    n, size, half = *x.shape, 1
    while half < size:
        pairs = x.reshape(n, size // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, size)
        half *= 2
    return x / np.sqrt(size)


@dataclass
class Tables:
    """Hash tables for vectors of ``dim`` components (``longest`` is set where rows differ in length)."""

    dim: int
    rows: int
    longest: float | None = None
    tables: int = TABLES
    probes: int = 1
    seed: int = 7
    padded: int = field(init=False)
    widths: list[int] = field(init=False)

    def __post_init__(self):
        size = self.dim + (self.longest is not None)
        self.padded = max(2, 1 << (size - 1).bit_length())
        wanted, self.widths = max(2, self.rows // PER_BUCKET), []
        while wanted > 2 * self.padded:
            self.widths.append(self.padded)
            wanted = -(-wanted // (2 * self.padded))
        self.widths.append(min(self.padded, 1 << max(0, (-(-wanted // 2) - 1).bit_length())))
        shape = (self.tables, len(self.widths), 3, self.padded)
        self.signs = np.random.default_rng(self.seed).choice([-1.0, 1.0], shape)

    @property
    def buckets(self) -> int:
        return int(np.prod([2 * w for w in self.widths]))

    @property
    def shards(self) -> int:
        return min(self.buckets, max(1, -(-self.rows // SHARD)))

    def shard(self, bucket: np.ndarray) -> np.ndarray:
        return bucket * self.shards // self.buckets

    def _units(self, x: np.ndarray, as_rows: bool) -> np.ndarray:
        unit = np.zeros((len(x), self.padded))
        if self.longest is not None and as_rows:
            unit[:, : self.dim] = x / self.longest
            rest = 1 - (unit[:, : self.dim] ** 2).sum(axis=1)
            unit[:, self.dim] = np.sqrt(np.maximum(rest, 0))
        else:
            scaled = x / np.abs(x).max(axis=1, keepdims=True)
            unit[:, : self.dim] = scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))
        return unit

    def _axes(self, unit: np.ndarray, table: int) -> Iterator[np.ndarray]:
        """For each function of a table the coordinates along its signed axes."""
        for signs, width in zip(self.signs[table], self.widths, strict=True):
            x = unit
            for flips in signs:
                x = hadamard(x * flips)
            yield np.concatenate([x[:, :width], -x[:, :width]], axis=1)

    def keys(self, x: np.ndarray) -> np.ndarray:
        """The bucket of every row in every table."""
        unit = self._units(x, True)
        found = np.zeros((self.tables, len(x)), dtype=np.int64)
        for table in range(self.tables):
            for along in self._axes(unit, table):
                found[table] = found[table] * along.shape[1] + along.argmax(axis=1)
        return found

    def orders(self, queries: np.ndarray, table: int, most: int) -> Iterator[np.ndarray]:
        """For each query its ``most`` best buckets of a table, best first."""
        functions = list(self._axes(self._units(queries, False), table))
        each = max(2, int(ORDERED ** (1 / len(functions))))
        best = [np.argsort(-along, axis=1, kind="stable")[:, :each] for along in functions]
        scores = [np.take_along_axis(along, top, 1) for along, top in zip(functions, best, strict=True)]
        if len(functions) == 1:
            yield from best[0][:, :most]
            return
        for q in range(len(queries)):
            score, bucket = scores[0][q], best[0][q]
            for along, top, own in zip(functions[1:], best[1:], scores[1:], strict=True):
                score = np.add.outer(score, own[q]).ravel()
                bucket = np.add.outer(bucket * along.shape[1], top[q]).ravel()
            yield bucket[np.argsort(-score, kind="stable")[:most]]

    def order(self, query: np.ndarray, table: int, most: int) -> np.ndarray:
        return next(self.orders(query[None], table, most))


def _vectors(column: pa.Array, dtype: str, dim: int) -> np.ndarray:
    """Rows of binary vectors as one matrix of doubles, zeros behind shorter ones."""
    raw = column.to_pylist()
    found = np.zeros((len(raw), dim))
    for i, r in enumerate(raw):
        own = np.frombuffer(r, dtype=dtype)
        found[i, : len(own)] = own
    return found


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of lists as one matrix of doubles, zeros behind shorter ones."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(lengths) and (lengths == dim).all():
        return flat.reshape(-1, dim)
    found = np.zeros((len(lengths), dim))
    row = np.repeat(np.arange(len(lengths)), lengths)
    found[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return found


def _usable(embeddings: DataFrame, vector: str) -> DataFrame:
    """``id, vector`` of the rows that take part."""
    kind = "float" if embeddings.schema[vector].dataType.elementType.typeName() == "float" else "double"
    rows = embeddings.select(
        F.col("vec_id").cast("bigint").alias("id"), F.col(f"`{vector}`").cast(f"array<{kind}>").alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))


def _best(query_ids, queries, ids, rows, count: int) -> tuple[np.ndarray, ...]:
    """Place of query and row of the ``count`` best rows of each query (more at ties)."""
    scores = queries @ rows.T
    scores[query_ids[:, None] == ids[None, :]] = -np.inf
    if scores.shape[1] <= count:
        return np.nonzero(scores > -np.inf)
    least = np.partition(scores, -count, axis=1)[:, -count]
    # Matrix products may round differently from the scores that are compared in the end.
    slack = 1e-9 * np.abs(queries).max(axis=1) * np.abs(rows).max() * rows.shape[1]
    return np.nonzero((scores >= (least - slack)[:, None]) & (scores > -np.inf))


def _probe_ranks(tables: Tables, queries: np.ndarray, truth: np.ndarray, of: np.ndarray) -> np.ndarray:
    """For each true neighbour (row of ``truth``, of query ``of``) the least number of probes that reaches it."""
    keys = tables.keys(truth)
    ranks = np.full(len(truth), tables.buckets, dtype=np.int64)
    rows = [np.flatnonzero(of == q) for q in range(len(queries))]
    for table in range(tables.tables):
        for own, order in zip(rows, tables.orders(queries, table, ORDERED), strict=True):
            place = {int(b): i for i, b in enumerate(order)}
            found = [place.get(int(k), tables.buckets) for k in keys[table, own]]
            ranks[own] = np.minimum(ranks[own], np.array(found, dtype=np.int64))
    return ranks + 1


def _truth(ids: np.ndarray, queries: np.ndarray, dim: int, count: int):
    """The best rows of a task for each of the sampled queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_ids = np.zeros(0, dtype=np.int64)
        held, of, scores = np.zeros((0, dim)), np.zeros(0, dtype=np.int64), np.zeros(0)
        for batch in batches:
            own = batch.column(0).to_numpy()
            if not len(own):
                continue
            rows = _matrix(batch.column(1), dim)
            q, r = _best(ids, queries, own, rows, count)
            found = (queries[q] * rows[r]).sum(axis=1)
            held_ids, of = np.concatenate([held_ids, own[r]]), np.concatenate([of, q])
            held, scores = np.concatenate([held, rows[r]]), np.concatenate([scores, found])
            order = np.lexsort((held_ids, -scores, of))
            rank = np.arange(len(order)) - np.searchsorted(of[order], of[order])
            order = order[rank < count]
            held_ids, held, of, scores = held_ids[order], held[order], of[order], scores[order]
        columns = [pa.array(of), pa.array(held_ids), pa.array(scores), pa.array(held.tolist(), pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["query", "id", "score", "vector"])

    return run


def fit(embeddings: DataFrame, every: int, count: int = 20, vector: str = "embedding") -> Tables | None:
    """Tables for the rows as they are: size by their number, probes by the recall on the sample. None: no query."""
    rows = _usable(embeddings, vector)
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    least, most, dim, number = rows.agg(
        F.sqrt(F.min(square)), F.sqrt(F.max(square)), F.max(F.size("vector")), F.count(F.lit(1))
    ).first()
    asked = rows.filter(F.col("id") % every == 0).orderBy(F.xxhash64("id"), "id", "vector").limit(SAMPLE).collect()
    if not asked:
        return None
    tables = Tables(dim, number, most if most - least > 1e-6 * most else None)
    ids = np.array([r.id for r in asked], dtype=np.int64)
    queries = np.zeros((len(asked), dim))
    for i, r in enumerate(asked):
        queries[i, : len(r.vector)] = r.vector
    found = rows.mapInArrow(
        _truth(ids, queries, dim, count), "query bigint, id bigint, score double, vector array<double>"
    )
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    truth = found.withColumn("rank", rank).filter(F.col("rank") <= count).select("query", "vector").collect()
    if truth:
        of = np.array([r.query for r in truth], dtype=np.int64)
        ranks = np.sort(_probe_ranks(tables, queries, np.array([r.vector for r in truth]), of))
        tables.probes = int(min(ranks[int(np.ceil(RECALL * len(ranks))) - 1], tables.buckets))
    return tables


def _posted(tables: Tables, dtype: str, count: int):
    """Rows of every table: the class of a vector, with its smallest ids of the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            exact = _matrix(batch.column(1), tables.dim) + 0.0  # no negative zeros
            own = exact.astype(dtype)
            _, first, label = np.unique(own.view(f"V{own.itemsize * own.shape[1]}").ravel(), return_index=True, return_inverse=True)
            order = np.lexsort((ids, label))
            ends = np.searchsorted(label[order], np.arange(len(first) + 1))
            members = [np.unique(ids[order[a:b]])[: count + 1].tolist() for a, b in zip(ends[:-1], ends[1:])]
            raw = [own[i].tobytes() for i in first]
            hashes = np.array([xxhash.xxh3_64_intdigest(r) >> 1 for r in raw], dtype=np.int64)
            keys = tables.keys(exact[first])
            for table in range(tables.tables):
                columns = [
                    pa.array(np.full(len(first), table, dtype=np.int32)),
                    pa.array(tables.shard(keys[table])),
                    pa.array(hashes),
                    pa.array(raw, pa.binary()),
                    pa.array(members, pa.list_(pa.int64())),
                    pa.array(keys[table][:, None].tolist(), pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=_NAMES)

    return run


_NAMES = ["table", "shard", "hash", "vector", "ids", "buckets"]
_ROWS = "table int, shard bigint, hash bigint, vector binary, ids array<bigint>, buckets array<bigint>"


def _asked(tables: Tables, dtype: str):
    """Queries, once for each shard that they probe, with the buckets they look into there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[dict] = []
            if not batch.num_rows:
                continue
            exact = _matrix(batch.column(1), tables.dim)
            ids, raw = batch.column(0).to_pylist(), [q.tobytes() for q in exact.astype(dtype)]
            for table in range(tables.tables):
                for i, vector, best in zip(ids, raw, tables.orders(exact, table, tables.probes), strict=True):
                    probed = np.sort(best)
                    shards, begins = np.unique(tables.shard(probed), return_index=True)
                    for shard, own in zip(shards.tolist(), np.split(probed, begins[1:]), strict=True):
                        key = dict(table=table, shard=shard, hash=0)
                        made.append({**key, "vector": vector, "ids": [i], "buckets": own.tolist()})
                    if len(made) >= 2000:
                        yield pa.RecordBatch.from_pylist(made, schema=_ARROW)
                        made = []
            if made:
                yield pa.RecordBatch.from_pylist(made, schema=_ARROW)

    return run


_ARROW = pa.schema(
    [
        ("table", pa.int32()),
        ("shard", pa.int64()),
        ("hash", pa.int64()),
        ("vector", pa.binary()),
        ("ids", pa.list_(pa.int64())),
        ("buckets", pa.list_(pa.int64())),
    ]
)


class _Block:
    """Rows of one block, as classes of equal vectors in the order of their buckets."""

    def __init__(self, count: int):
        self.count = count
        self.ids: dict[bytes, list[int]] = {}
        self.bucket: dict[bytes, int] = {}

    def add(self, vector: bytes, ids: list[int], bucket: int) -> None:
        held = self.ids.get(vector)
        if held is not None:
            ids = sorted({*held, *ids})[: self.count + 1]
        self.ids[vector], self.bucket[vector] = ids, bucket

    def close(self, dtype: str, dim: int) -> None:
        order = sorted(self.ids, key=self.bucket.__getitem__)
        self.rows = _vectors(pa.array(order, pa.binary()), dtype, dim)
        self.members = [self.ids[v] for v in order]
        self.sizes = np.array([len(m) for m in self.members], dtype=np.int64)
        self.alone = np.array([m[0] if len(m) == 1 else -1 for m in self.members], dtype=np.int64)
        self.several = self.sizes > 1
        buckets = np.array([self.bucket[v] for v in order], dtype=np.int64)
        self.buckets, begins = np.unique(buckets, return_index=True)
        self.ends = np.append(begins, len(buckets))
        self.ids, self.bucket = {}, {}

    def answer(self, asked: list[tuple[int, bytes, list[int]]], dtype: str, dim: int) -> pa.RecordBatch:
        """The best of the block for some queries, scored one pair after the other."""
        count = self.count
        own = np.array([a[0] for a in asked], dtype=np.int64)
        queries = _vectors(pa.array([a[1] for a in asked], pa.binary()), dtype, dim)
        probing: dict[int, list[int]] = {}
        for i, (_, _, buckets) in enumerate(asked):
            for b in buckets:
                probing.setdefault(b, []).append(i)
        places: list[tuple[np.ndarray, np.ndarray]] = []
        for b, of in probing.items():
            at = int(np.searchsorted(self.buckets, b))
            if at == len(self.buckets) or self.buckets[at] != b:
                continue
            begin, end = self.ends[at], self.ends[at + 1]
            of = np.array(of)
            # A class of several ids always has one besides the query's.
            ids = np.where(self.several[begin:end], np.iinfo(np.int64).min, self.alone[begin:end])
            q, r = _best(own[of], queries[of], ids, self.rows[begin:end], count)
            places.append((of[q], r + begin))
        q, r = (np.concatenate(x) for x in zip(*places)) if places else (np.zeros(0, np.int64),) * 2
        found = (queries[q] * self.rows[r]).sum(axis=1)
        # Members of classes beside each other, then each query's best.
        sizes = self.sizes[r]
        ids = np.array([i for c in r.tolist() for i in self.members[c]], dtype=np.int64)
        q, found = np.repeat(q, sizes), np.repeat(found, sizes)
        other = ids != own[q]
        q, found, ids = q[other], found[other], ids[other]
        order = np.lexsort((ids, -found, q))
        rank = np.arange(len(order)) - np.searchsorted(q[order], q[order])
        order = order[rank < count]
        columns = [pa.array(own[q[order]]), pa.array(ids[order]), pa.array(found[order])]
        return pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])


def _answers(tables: Tables, dtype: str, count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = block = None
        open_, asked = True, []

        def flush():
            nonlocal asked
            if asked:
                yield block.answer(asked, dtype, tables.dim)
                asked = []

        for batch in batches:
            names = ("table", "shard", "block", "is_query", "vector", "ids", "buckets")
            columns = (batch.column(c).to_pylist() for c in names)
            for *own, is_query, vector, ids, buckets in zip(*columns, strict=True):
                if own != key:
                    yield from flush()
                    key, block, open_ = own, _Block(count), True
                if not is_query:
                    block.add(vector, ids, buckets[0])
                    continue
                if open_:
                    block.close(dtype, tables.dim)
                    open_ = False
                asked.append((ids[0], vector, buckets))
                if len(asked) == STEP:
                    yield from flush()
        yield from flush()

    return run


def search(
    embeddings: DataFrame, tables: Tables | None, every: int, count: int = 20, vector: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``count`` best found for each row whose id is divisible by ``every``."""
    empty = "query_id bigint, vec_id bigint, score double"
    rows = _usable(embeddings, vector)
    if tables is None:
        found = embeddings.sparkSession.createDataFrame([], empty)
    else:
        dtype = "<f4" if rows.schema["vector"].dataType.elementType.typeName() == "float" else "<f8"
        posted = rows.mapInArrow(_posted(tables, dtype, count), _ROWS)
        sizes = posted.groupBy("table", "shard").agg(F.count(F.lit(1)).alias("size"))
        crowded = small_side(
            sizes.filter(F.col("size") > SHARD).select("table", "shard", F.ceil(F.col("size") / SHARD).alias("blocks")),
            LISTED,
        )
        blocks = F.coalesce("blocks", F.lit(1))
        of_rows = posted.join(crowded, ["table", "shard"], "left").withColumn("block", F.col("hash") % blocks)
        asked = rows.filter(F.col("id") % every == 0).distinct().mapInArrow(_asked(tables, dtype), _ROWS)
        of_queries = asked.join(crowded, ["table", "shard"], "left").withColumn(
            "block", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1))
        )
        key, kept = ("table", "shard", "block"), ("vector", "ids", "buckets")
        both = of_rows.select(*key, F.lit(False).alias("is_query"), *kept).unionByName(
            of_queries.select(*key, F.lit(True).alias("is_query"), *kept)
        )
        # Work follows pairs, not bytes: a task for each block.
        parts = min(tables.tables * tables.shards, 10_000)
        found = (
            both.repartition(parts, *key).sortWithinPartitions(*key, "is_query").mapInArrow(
                _answers(tables, dtype, count), empty
            )
        )
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= count).select("query_id", "rank", "vec_id", "score")
