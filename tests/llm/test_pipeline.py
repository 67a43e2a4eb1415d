"""The pipeline stage by stage, each against brute force on the rows it was given."""

import hashlib

import corpus_pipeline
import pandas as pd
import pytest
from test_duplicates import groups, removed
from test_texts import places_of, words_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", params=["given", "awkward"])
def passed(request, spark, unique_docs, tmp_path_factory):
    """The input of every stage and its output, as pandas."""
    docs = spark.read.parquet(f"{SF}/documents.parquet") if request.param == "given" else unique_docs
    folder, found = tmp_path_factory.mktemp("stages"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(folder / name)
        stage(spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        found[name] = (docs.toPandas(), out.toPandas())
        docs = out
    return found


def rows(frame):
    return [(int(i), t) for i, t in zip(frame.doc_id, frame.text, strict=True)]


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "copies", "passages", "leaks", "sequences"]


def test_columns_stay_until_the_last_stage(passed):
    for name, (given, made) in passed.items():
        if name != "sequences":
            assert list(made.columns) == list(given.columns) and set(made.doc_id) <= set(given.doc_id)


def test_language_rejects_few(passed):
    given, made = passed["language"]
    gone = given[~given.doc_id.isin(made.doc_id)]
    assert all(len(t or "") < 100 or t.count(t[:5]) > 20 for t in gone.text)


def test_one_document_of_each_group(passed):
    given, made = passed["copies"]
    assert sorted(rows(made), key=str) == sorted(
        [r for r, g in zip(sorted(rows(given)), groups(sorted(rows(given)), 5), strict=True) if g[3]], key=str
    )


def test_passages_go(passed):
    given, made = passed["passages"]
    left = []
    for i, text in rows(made):
        kept = b" ".join((text or "").encode().split())
        left.append((i, hashlib.sha256(kept).hexdigest()))
    assert sorted(left) == sorted((i, digest) for i, _, _, digest in removed(rows(given), 50))
    whole = {i: t for i, t in rows(given)}
    for i, n, gone, _ in removed(rows(given), 50):
        if not gone:
            assert dict(rows(made))[i] == whole[i]


def test_leaks_go(passed):
    given, made = passed["leaks"]
    windows = []
    for text in pd.read_parquet(f"{SF}/benchmark.parquet").text:
        words = words_of(text)
        n = min(10, len(words))
        windows += [words[k : k + n] for k in range(len(words) - n + 1) if n]
    clean = [(i, t) for i, t in rows(given) if not any(places_of(w, words_of(t)) for w in windows)]
    assert sorted(rows(made)) == sorted(clean)


def test_sequences_hold_all_documents(passed):
    given, made = passed["sequences"]
    assert set(made.doc_id) == set(given.doc_id)
    assert (made.groupby("sequence_id").length.sum() <= 2048).all()
    assert (made.groupby("doc_id").piece.nunique() == made.groupby("doc_id").piece.max() + 1).all()


def test_run_applies_the_stages(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
