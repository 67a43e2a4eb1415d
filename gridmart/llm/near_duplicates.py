"""Near-duplicate documents by an inverted join over MinHash signature coordinates.

1. Each document's set of ``shingle``-word shingles gets a signature of ``COORDINATES`` minima. Documents with the
   same set are one class; from here on the class with its smallest id stands for them.
2. Every (coordinate, value) pair is a token. Two classes are candidates if ``MATCHES`` tokens or more collide.
   Tokens of one class alone are dropped; a class with fewer than ``MATCHES`` others has no partner. Of the rest,
   rarest first, only the prefix is posted that two candidates can't both miss; the others are skipped, and
   merged only for pairs that meet: the full count of collisions is taken there.
3. Candidates are confirmed on the full sets of their shingles.
4. Links make components.

Large posting lists are not expanded into all pairs. First the member whose tokens are the most frequent, the one in
the middle of a group of copies, is paired with the others; then, where a list still lies in several components,
another member chosen by hash. What then remains is every pair of a list whose members are in different components.
Of the documents in such lists the shingles are counted that none of the others has: those that thereby can't be
similar enough to any member drop out, as do lists that then lie in one component. Lists that share a document
make a cluster, and in each cluster the documents outside its largest component are held, in blocks, against all
others on their full sets. So no link between different components is lost, and no list is expanded into pairs.

At a similarity of exactly 0.8 a pair has fewer than 38 of 64 equal coordinates with a chance of about 3e-5,
at 0.85 of 1e-9; nothing else is lost.

Edge cases: NULL texts and texts without words have an empty set and are linked with nothing. Texts shorter than a
shingle have one, of all their words. Rows with a NULL id are linked with nothing and kept. Rows that share an id
count as one document, with one ``kept`` for all of them, so `one_of_each` keeps all or none. Columns of any name pass through.
An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from gridmart.llm.components import components
from gridmart.llm.rows import map_texts
from gridmart.llm.tables import keep
from gridmart.llm.words import Words, mix, slices, span_hashes, split, texts_of

SHINGLE = 5
PERCENT = 80
COORDINATES = 64
MATCHES = 38
#: Members that are compared with one copy of their list's first text.
MEMBERS = 500
#: Documents of a cluster that are held against ANSWERS others at a time.
QUERIES = 256
ANSWERS = 4096

SKETCH = "n_shingles bigint, set_key binary, tokens array<bigint>"

_FACTORS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ascending within each, and where each text's begin."""
    counts = words.counts()
    number = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), number)
    within = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    starts = words.first[text] + within
    length = np.minimum(counts, size)[text]
    hashes = span_hashes(words.hashes, starts, starts + length) ^ mix(length.astype(np.uint64))
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    hashes, text = hashes[new], text[new]
    return hashes, np.searchsorted(text, np.arange(len(counts) + 1))


def _sketch(size: int):
    def make():
        def function(texts):
            hashes, begins = shingles(split(texts, lower=True), size)
            numbers = np.diff(begins)
            filled = np.flatnonzero(numbers)
            tokens = np.zeros((len(texts), COORDINATES), dtype=np.int64)
            for k in range(COORDINATES if len(filled) else 0):
                # Nothing stands between the sets of texts that have one.
                least = np.minimum.reduceat(hashes * _FACTORS[k], begins[filled])
                tokens[filled, k] = mix(least ^ _FACTORS[k]).view(np.int64)
            raw = hashes.tobytes()
            keys = [
                xxhash.xxh3_128_digest(raw[8 * a : 8 * b]) if b > a else None
                for a, b in zip(begins[:-1], begins[1:], strict=True)
            ]
            lists = [t if n else [] for t, n in zip(tokens.tolist(), numbers, strict=True)]
            return [numbers, keys, lists]

        return function

    return make


def _postings(classes: DataFrame) -> DataFrame:
    """``token, id, n, weight``: the prefix of each class, in lists of two or more."""
    posted = classes.select("id", "n", F.explode("tokens").alias("token"))
    shared = posted.groupBy("token").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    ordered = (
        posted.join(shared, "token")
        .groupBy("id", "n")
        .agg(F.sort_array(F.collect_list(F.struct("size", "token"))).alias("own"))
        .filter(F.size("own") >= MATCHES)
    )
    prefix = F.slice("own", 1, F.size("own") - (MATCHES - 1))
    weight = F.aggregate("own", F.lit(0).cast("bigint"), lambda w, t: w + t["size"]).alias("weight")
    listed = ordered.select("id", "n", weight, F.explode(prefix).alias("p"))
    return listed.select("p.token", "id", "n", "weight")


def _colliding(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` whose sizes allow the similarity and whose signatures match often enough."""

    def side(name: str) -> DataFrame:
        return classes.select(
            F.col("id").alias(name), F.col("n").alias(f"n_{name}"), F.col("tokens").alias(f"tokens_{name}")
        )

    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    collisions = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .filter((small * 100 >= large * percent) & (collisions >= MATCHES))
        .select("a", "b")
    )


def _confirm(size: int, percent: int):
    """Sorted texts, each list's first one ahead: keeps the pairs that are similar enough."""

    def one(text: bytes | None) -> np.ndarray:
        return shingles(split([text], lower=True), size)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, head_set = None, np.zeros(0, np.uint64)
        for batch in batches:
            found: tuple[list, list] = ([], [])
            texts = texts_of(batch.column("text"))
            ids = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)
            for (a, b), text in zip(ids, texts, strict=True):
                if b is None:
                    if head != a:
                        head, head_set = a, one(text)
                    continue
                other = one(text)
                both = len(np.intersect1d(head_set, other, assume_unique=True))
                if 100 * both >= percent * (len(head_set) + len(other) - both):
                    found[0].append(a)
                    found[1].append(b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in found], names=["u", "v"]
            )

    return run


def _links(pairs: DataFrame, bodies: DataFrame, size: int, percent: int) -> DataFrame:
    """Confirmed links ``u, v``. A long list is dealt over several copies of its first text."""
    heads = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("parts"))
    part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    first = heads.join(bodies, heads.a == bodies.id).select("a", part, F.lit(None).cast("bigint").alias("b"), "text")
    others = (
        pairs.join(heads, "a")
        .join(bodies, F.col("b") == F.col("id"))
        .select("a", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"), "b", "text")
    )
    return (
        first.unionByName(others)
        .repartition("a", "part")
        .sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
        .mapInArrow(_confirm(size, percent), "u bigint, v bigint")
    )


def _first_pairs(postings: DataFrame) -> DataFrame:
    heads = postings.groupBy("token").agg(
        F.max_by("id", F.struct("weight", -F.col("id"))).alias("a"),
        F.min("id").alias("x"),
        F.max("id").alias("y"),
    )
    return (
        postings.join(heads.filter("x < y").select("token", "a"), "token")
        .filter("id <> a")
        .select("a", F.col("id").alias("b"))
        .distinct()
    )


def _in_several(own: DataFrame) -> DataFrame:
    """The lists of ``token, component, ...`` that lie in more than one component."""
    several = own.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    return own.join(several.filter("x < y").select("token"), "token")


def _placed(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """Postings of lists that lie in several components, with these."""
    return _in_several(
        postings.join(labels, F.col("id") == F.col("u"), "left").select(
            "token", "id", "n", F.coalesce("v", "id").alias("component")
        )
    )


def _emit(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = texts_of(batch.column("text")), batch.column("id").to_numpy()
            for begin, end in slices(texts):
                hashes, begins = shingles(split(texts[begin:end], lower=True), size)
                owner = np.repeat(ids[begin:end], np.diff(begins))
                columns = [pa.array(owner), pa.array(hashes.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "hash"])

    return run


def _own_shingles(ids: DataFrame, bodies: DataFrame, size: int) -> DataFrame:
    """``owner, alone``: how many shingles of a document no other of ``ids`` has."""
    told = bodies.join(ids, "id").select("id", "text").mapInArrow(_emit(size), "id bigint, hash bigint")
    once = told.groupBy("hash").agg(F.min("id").alias("owner"), F.max("id").alias("last"))
    return once.filter("owner = last").groupBy("owner").agg(F.count(F.lit(1)).alias("alone"))


def _reachable(placed: DataFrame, bodies: DataFrame, size: int, percent: int) -> DataFrame:
    """Postings of documents whose own shingles leave room for a link within the list, where the lists
    still lie in several components."""
    alone = _own_shingles(placed.select("id").distinct(), bodies, size)
    known = placed.join(alone, F.col("id") == F.col("owner"), "left").withColumn(
        "common", F.col("n") - F.coalesce("alone", F.lit(0))
    )
    smallest = placed.groupBy("token").agg(F.min("n").alias("least"))
    partner = F.greatest("least", F.ceil(F.col("n") * percent / 100))
    within = F.col("common") * 100 >= (F.col("n") + partner - F.col("common")) * percent
    kept = known.join(smallest, "token").filter(within)
    return _in_several(kept.select("token", "id", "component"))


def _second_pairs(placed: DataFrame) -> DataFrame:
    head = F.min_by(F.struct("id", "component"), F.xxhash64("id", "token")).alias("head")
    heads = placed.groupBy("token").agg(head)
    return (
        placed.join(heads, "token")
        .filter("component <> head.component")
        .select(F.col("head.id").alias("a"), F.col("id").alias("b"))
        .distinct()
    )


def _clusters(placed: DataFrame) -> DataFrame:
    """``id, n, component, cluster, queried``: each document of the lists once. Queried are all but those of the
    cluster's largest component, as one of any two in different components is among them."""
    joined = placed.groupBy("token").agg(F.min("id").alias("first"))
    edges = placed.join(joined, "token").select(F.col("id").alias("u"), F.col("first").alias("v"))
    labels = components(edges).withColumnsRenamed({"u": "_u", "v": "_v"})
    own = (
        placed.select("id", "component")
        .distinct()
        .join(labels, F.col("id") == F.col("_u"), "left")
        .select("id", "component", F.coalesce("_v", "id").alias("cluster"))
    )
    sizes = own.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("cluster").agg(
        F.max_by("component", F.struct("size", "component")).alias("largest"),
        F.ceil((F.sum("size") - F.max("size")) / QUERIES).cast("int").alias("query_parts"),
        F.ceil(F.sum("size") / ANSWERS).cast("int").alias("answer_parts"),
    )
    return own.join(largest, "cluster").withColumn("queried", F.col("component") != F.col("largest"))


def _hold(size: int, percent: int):
    """Sorted rows of blocks, queries first: links between documents of different components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, queries, index = None, [], None
        for batch in batches:
            texts = texts_of(batch.column("text"))
            names = ("cluster", "query_part", "answer_part", "is_query", "id", "component")
            columns = [batch.column(c).to_pylist() for c in names]
            found: tuple[list, list] = ([], [])
            for (*own, is_query, i, component), text in zip(zip(*columns, strict=True), texts, strict=True):
                if own != block:
                    block, queries, index = own, [], None
                hashes = shingles(split([text], lower=True), size)[0]
                if is_query:
                    queries.append((i, component, hashes))
                    continue
                if index is None:
                    lengths = np.array([len(q[2]) for q in queries])
                    held = np.concatenate([q[2] for q in queries] or [hashes[:0]])
                    order = np.argsort(held, kind="stable")
                    owner = np.repeat(np.arange(len(queries)), lengths)[order]
                    index = held[order], owner, lengths
                held, owner, lengths = index
                low, high = np.searchsorted(held, hashes, "left"), np.searchsorted(held, hashes, "right")
                runs = high - low
                at = np.repeat(low - np.cumsum(runs) + runs, runs) + np.arange(runs.sum())
                both = np.bincount(owner[at], minlength=len(queries))
                for q in np.flatnonzero(100 * both >= percent * (lengths + len(hashes) - both)):
                    if queries[q][1] != component:
                        found[0].append(queries[q][0])
                        found[1].append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in found], names=["u", "v"]
            )

    return run


def _held_links(clusters: DataFrame, bodies: DataFrame, size: int, percent: int) -> DataFrame:
    """Links of the queried documents with any of their cluster: each block of queries meets each block
    of documents in a task."""

    def numbers(count: str):
        return F.sequence(F.lit(0), F.col(count) - 1)

    def part(count: str):
        return F.pmod(F.xxhash64("id"), count).cast("int")

    kept = ["cluster", "query_part", "answer_part", "is_query", "id", "component"]
    texts = clusters.join(bodies, "id")
    queries = texts.filter("queried").select(
        "*",
        part("query_parts").alias("query_part"),
        F.explode(numbers("answer_parts")).alias("answer_part"),
        F.lit(True).alias("is_query"),
    )
    answers = texts.select(
        "*",
        F.explode(numbers("query_parts")).alias("query_part"),
        part("answer_parts").alias("answer_part"),
        F.lit(False).alias("is_query"),
    )
    return (
        queries.select(*kept, "text")
        .unionByName(answers.select(*kept, "text"))
        .repartition("cluster", "query_part", "answer_part")
        .sortWithinPartitions("cluster", "query_part", "answer_part", F.desc("is_query"))
        .mapInArrow(_hold(size, percent), "u bigint, v bigint")
    )


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, text: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id, kept`` for every document."""
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col(text).cast("string").alias("text"))
    sketches = keep(
        map_texts(texts, _sketch(shingle), SKETCH).select("row.doc_id", "out.*"), "sketches"
    )
    filled = sketches.filter("set_key IS NOT NULL AND doc_id IS NOT NULL")
    classes = keep(
        filled.groupBy("set_key").agg(
            F.min("doc_id").alias("id"),
            F.any_value("n_shingles").alias("n"),
            F.any_value("tokens").alias("tokens"),
        ),
        "classes",
    )
    postings = keep(_postings(classes), "postings")
    involved = postings.select("id").distinct()
    # Both sides grow with the corpus, so it is the same shuffle join at every size.
    bodies = keep(
        texts.join(involved.hint("merge"), F.col("doc_id") == F.col("id")).select("id", "text"),
        "bodies",
    )

    tested = keep(_colliding(_first_pairs(postings), classes, percent), "pairs")
    links = keep(_links(tested, bodies, shingle, percent), "links")
    labels = components(links)
    placed = keep(_placed(postings, labels), "placed")
    if not placed.isEmpty():
        mirrored = tested.select(F.col("b").alias("a"), F.col("a").alias("b"))
        fresh = _second_pairs(placed).join(tested.unionByName(mirrored), ["a", "b"], "left_anti")
        candidates = keep(_colliding(fresh, classes, percent), "pairs")
        links = keep(_links(candidates, bodies, shingle, percent), "links")
        labels = components(labels.unionByName(links))
        placed = keep(_placed(placed.drop("component"), labels), "placed")
        placed = keep(_reachable(placed, bodies, shingle, percent), "reachable")
    if not placed.isEmpty():
        clusters = keep(_clusters(placed), "clusters")
        links = keep(_held_links(clusters, bodies, shingle, percent), "links")
        labels = components(labels.unionByName(links))

    known = classes.join(labels, F.col("id") == F.col("u"), "left").select(
        "set_key", F.col("id").alias("class_id"), F.coalesce("v", "id").alias("component_id")
    )
    whole = sketches.join(known, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return whole.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The document with the smallest id of each component, with its columns."""
    gone = near_duplicates(docs, shingle, percent).filter("NOT kept").select("doc_id").distinct()
    # As above: what goes grows with the corpus. A row as one column: its fields may have any names.
    rows = docs.select(F.struct("*").alias("row"))
    gone = keep(gone, "gone").hint("merge")
    return rows.join(gone, F.col("row.doc_id").cast("bigint") == F.col("doc_id"), "left_anti").select("row.*")
