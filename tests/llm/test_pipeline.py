"""The pipeline's stages, each against a plain version of itself on the stage's own input."""

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from stallbook.sources.shared import pinned

from .test_decontaminate import plain_found
from .test_lines import plain
from .test_simhash import plain_components, plain_fingerprint

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, table):
    """What goes into each stage and comes out of it, by the stage's name."""
    docs, found = table("documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = pinned(stage(spark, docs, FOLDER))
        found[name] = docs.orderBy("doc_id").collect(), out.orderBy("doc_id").collect()
        docs = out
    return found


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "bpe"]


def test_all_but_the_last_return_documents(steps, table):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        given, out = steps[name]
        assert [list(row.asDict()) for row in out[:1]] == [table("documents").columns]
        assert {row.doc_id for row in out} <= {row.doc_id for row in given}


def test_quality_keeps_texts_as_they_are(steps):
    given, out = steps["quality_classifier"]
    before = {row.doc_id: row for row in given}
    assert 0 < len(out) < len(given)
    assert all(before[row.doc_id] == row for row in out)


def test_quality_drops_toxic_documents(spark):
    """The stage on 1,000 documents: a quarter of the toxic ones have no word of their own."""
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels"))
    kept = {row.doc_id for row in corpus_pipeline.keep_good(spark, documents, "/root/testdata/sf0.01").collect()}
    toxic = [row.doc_id for row in labels.where("toxic = 1").collect()]
    good = [row.doc_id for row in labels.where("quality = 1 and toxic = 0").collect()]
    assert sum(doc in kept for doc in toxic) < 0.3 * len(toxic)
    assert sum(doc in kept for doc in good) > 0.9 * len(good)


def test_line_dedup(steps):
    given, out = steps["line_dedup"]
    expected = plain([row.text for row in given])
    assert [row.text for row in out] == expected
    assert [row.doc_id for row in out] == [row.doc_id for row in given]
    changed = [(a, b) for a, b in zip(given, out) if a.text != b.text]
    assert changed and all(b.n_chars == len(b.text) for _, b in changed)
    assert all(a == b for a, b in zip(given, out) if a.text == b.text)


def test_near_dedup_keeps_one_of_each_group(steps):
    given, out = steps["simhash_near_dedup"]
    expected = plain_components({row.doc_id: plain_fingerprint(row.text) for row in given})
    assert out == [row for row in given if expected[row.doc_id] == row.doc_id]
    assert len(out) < len(given)


def test_decontamination(steps, table):
    given, out = steps["benchmark_decontamination"]
    items = [(row.item_id, row.text) for row in table("benchmark").collect()]
    assert out == [row for row in given if not plain_found(row.text, items)]
    assert len(out) < len(given)


def test_run_is_its_stages_and_the_last_one_encodes(spark, steps):
    given, out = steps["bpe"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = []
    for row in given:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((row.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(decoded.encode()).hexdigest()))
    assert [tuple(row) for row in out] == expected
    assert [tuple(row) for row in corpus_pipeline.run(spark, FOLDER).orderBy("doc_id").collect()] == expected


def test_odd_rows_and_empty_tables(spark, odd_documents, no_documents):
    """Nulls, empty and repeated rows pass every stage; extra columns stay until the last."""
    for given in (odd_documents, no_documents):
        docs = given
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = pinned(stage(spark, docs, FOLDER))
            assert docs.columns == given.columns
        out = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
        assert out.count() == docs.count() <= given.count()
