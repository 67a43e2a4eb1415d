"""One registered query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import gridmart
from gridmart.llm import (
    chat,
    cross_polytope,
    decontaminate,
    langid,
    licenses,
    near_duplicates,
    packing,
    quality,
    repair,
    simhash,
    simple8b,
    spelling,
    substrings,
    twins,
)
from gridmart.llm.tables import documents, keep, read_table
from gridmart.session import new_work_path

#: At most so many rows and bytes of a table are in a Python worker at once.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def prepare(spark: SparkSession) -> None:
    """Bounded batches; workers find this package where it lies (on a cluster: installed there)."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    root = str(Path(gridmart.__file__).resolve().parents[1])
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def _texts(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    prepare(spark)
    return documents(spark, sf_dir).select("doc_id", "text", *more)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_work_path(spark, "token-files")
    simple8b.write(_texts(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"))
    return simple8b.read(spark, path).drop("ids")


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    columns = ("conv_id", "turn", "role", "text")
    messages = read_table(spark, sf_dir, "conversations").select(*columns)
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], messages.schema)
    log = chat.log_of(messages.unionByName(more))
    formatted = keep(chat.render(chat.fold(log)), "chat")
    return chat.digest(chat.read_back(formatted))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_texts(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(substrings.remove_repeats(_texts(spark, sf_dir), texts=False))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.compared(_texts(spark, sf_dir))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(_texts(spark, sf_dir), shingle=4).drop("class_id")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _texts(spark, sf_dir)
    return quality.digest(quality.score(docs, quality.fit(docs, read_table(spark, sf_dir, "labels"))))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    contents = langid.fit(_texts(spark, sf_dir, "lang"))
    return langid.digest(langid.predict(_texts(spark, sf_dir), contents))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = read_table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.occurrences(_texts(spark, sf_dir), benchmark))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(_texts(spark, sf_dir)))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = spelling.count_words(_texts(spark, sf_dir), change=spelling.typo)
    return spelling.variants(keep(counted, "vocabulary"))


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    embeddings = read_table(spark, sf_dir, "embeddings")
    tables = cross_polytope.fit(embeddings, every=20)
    return cross_polytope.search(embeddings, tables, every=20)


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    messages = read_table(spark, sf_dir, "conversations")
    harmed = repair.damage(messages)
    audits, repaired = repair.repair(repair.blocks(harmed))
    return repair.digest(harmed, audits, repaired, messages)


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_chat": op2_chat,
    "op3_packing": op3_packing,
    "op4_substrings": op4_substrings,
    "op5_simhash": op5_simhash,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_quality": op7_quality,
    "op8_language": op8_language,
    "op9_decontaminate": op9_decontaminate,
    "op10_licenses": op10_licenses,
    "op11_spelling": op11_spelling,
    "op12_neighbours": op12_neighbours,
    "op13_repair": op13_repair,
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

def _escaped(column: str) -> str:
    text = f"replace({column}, '\\', '\\\\')"
    for control in chat.CONTROL:
        text = f"replace({text}, '{control}', '{control[0]}\\{control[1:]}')"
    return text


ORACLE = {
    "op11_spelling": twins.SPELLING,
    "op13_repair": twins.REPAIR,
    "op2_chat": f"""
WITH m AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), c AS (
    SELECT conv_id, count(*) AS n_turns,
           string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text) AS said,
           coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
           sum({len(chat.TURN + chat.END) + 1} + length(replace({_escaped("role")}, chr(10), '{chat.LINE}'))
               + length({_escaped("text")})) AS inner_chars
    FROM m GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256,
       CAST(inner_chars + {len(chat.BEGIN + chat.STOP)} AS BIGINT) AS formatted_chars
FROM c
""",
    "op4_substrings": r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), v AS (
    SELECT doc_id, i, w[i:i + 49] AS words
    FROM (SELECT *, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
), f AS (
    SELECT words, min(doc_id) AS earliest FROM v GROUP BY words HAVING min(doc_id) < max(doc_id)
), gone AS (
    SELECT doc_id, list(DISTINCT place) AS places
    FROM (SELECT doc_id, unnest(range(i, i + 50)) AS place
          FROM v JOIN f USING (words) WHERE doc_id > earliest)
    GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(
           CASE WHEN places IS NULL THEN w
                ELSE list_filter(w, lambda x, i: NOT list_contains(places, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
""",
    "op6_near_duplicates": rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
    SELECT DISTINCT doc_id, w[i:i + 3] AS shingle
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
    FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM pairs JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
    WHERE 100 * common >= 80 * (x.n + y.n - common)
), reach AS (
    SELECT doc_id, doc_id AS other FROM d
    UNION
    SELECT reach.doc_id, b FROM reach JOIN links ON other = a
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id,
       doc_id = min(other) AS kept
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
""",
    "op9_decontaminate": rf"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(coalesce({_LOWER}, ''), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
    FROM benchmark
), p AS (
    SELECT DISTINCT item_id, w[i:i + least(len(w), 10) - 1] AS words, least(len(w), 10) AS n
    FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
), n AS (
    SELECT DISTINCT n FROM p
), v AS (
    SELECT doc_id, n, i, w[i:i + n - 1] AS words
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, n WHERE len(w) >= n)
), f AS (
    SELECT doc_id, v.i, v.n, item_id FROM v JOIN p ON v.words = p.words AND v.n = p.n
), hit AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM f) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM f) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
""",
}
