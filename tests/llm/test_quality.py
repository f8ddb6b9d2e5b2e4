import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stallbook.llm import common, quality, queries


def test_features():
    features = quality.Features()
    assert not len(features.buckets(None)) and not len(features.buckets(" \n"))
    assert set(features.buckets("word")) <= set(features.buckets("Word, word"))
    assert len(features.buckets("Word,")) > len(features.buckets("word"))


@pytest.fixture(scope="module")
def corpus(spark):
    """Half plain documents, a quarter with a bad word each, a quarter of signs; a third of all are labelled."""
    rows, labels, chance = [], [], random.Random(6)
    for k in range(2000):
        words = [f"word{chance.randrange(90)}" for _ in range(60)]
        kind = k % 4
        if kind == 2:
            words[k % 50] = ("nasty", "horrid")[k // 4 % 2]
            words[k % 40 + 3] = "horrid"
        if kind == 3:
            words = [w + "!!" for w in words]
        rows.append((k, " ".join(words), k % 5))
        if k % 3 == 0:
            labels.append((k, 0 if kind == 3 else 1, 1 if kind == 2 else 0))
    return spark.createDataFrame(rows, "doc_id long, text string, id int"), \
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_documents(corpus):
    """What no label names: plain ones are kept, the others are not."""
    kept = {row.doc_id for row in quality.resample(*corpus).collect()}
    unseen = [k for k in range(2000) if k % 3]
    plain = [k for k in unseen if k % 4 < 2]
    assert sum(k in kept for k in plain) > 0.95 * len(plain)
    assert sum(k in kept for k in unseen if k % 4 >= 2) < 0.05 * len(plain)


def test_held_out_documents_of_a_small_table(spark):
    """On 1,000 documents, labels that the models have not seen: a quarter of the toxic have no word of their own."""
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    kept = {row.doc_id for row in quality.resample(documents, labels.where(half)).collect()}
    unseen = labels.where(~half).collect()

    def share(rows):
        return sum(row.doc_id in kept for row in rows) / len(rows)

    assert share([row for row in unseen if row.quality == 1 and row.toxic == 0]) > 0.85
    assert share([row for row in unseen if row.toxic == 1]) < 0.4
    assert share([row for row in unseen if row.quality == 0 and row.toxic == 0]) < 0.2


def test_every_size_counts_evidence_alike():
    """A bucket that no good document has counts among few documents as among many, and chance at neither size."""
    for times in (1, 100):
        raw, good, bad = (np.array(counts) * times for counts in ([20.0, 20.0, 20.0], [0.0, 7.0, 6.0], [8.0, 1.0, 2.0]))
        ratios = quality._ratios(raw, good, bad, [200 * times, 67 * times, 20 * times])
        assert ratios[0] < -2 and not ratios[1] and not ratios[2]


def test_labels_that_are_all_good(corpus):
    """Then the target is told from all documents."""
    documents, labels = corpus
    kept = {row.doc_id for row in
            quality.resample(documents, labels.where("quality = 1 and toxic = 0"), keep=0.5).collect()}
    assert sum(k % 4 < 2 for k in kept) > 0.95 * len(kept)


def test_kth_largest(spark):
    scores = spark.range(50_000).selectExpr("cast(pmod(id * 7919, 49999) as double) as score")
    ordered = sorted((r.score for r in scores.collect()), reverse=True)
    for k in (1, 2, 777, 49_999, 50_000):
        assert quality._kth_largest(scores, k, few=50) == ordered[k - 1]
    assert quality._kth_largest(scores, 50_001) is None and quality._kth_largest(scores, 0) is None
    assert quality._kth_largest(spark.range(20_000).selectExpr("1d as score"), 5) == 1.0


def test_exactly_k_unless_rows_are_equal(corpus):
    documents, labels = corpus
    assert quality.resample(documents, labels, keep=0.25).count() == 500
    assert quality.resample(documents, labels, keep=0.0).count() == 0


def test_odd_rows(spark, odd_documents, no_documents, corpus):
    labels = spark.createDataFrame([(1, 1, 0), (1, None, None), (4, 1, 0), (5, 1, 0), (6, 0, None), (None, 1, 0), (7, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    kept = quality.resample(odd_documents, labels)
    assert kept.columns == [*odd_documents.columns, "log_weight", "sample_score"]
    rows = kept.collect()
    assert 0 < len(rows) <= odd_documents.count()
    assert all(r.log_weight <= 0 and math.isfinite(r.sample_score) for r in rows)
    assert quality.resample(no_documents, labels).collect() == []
    assert quality.resample(odd_documents, labels.where("false")).count() == odd_documents.count()


def test_long_texts_are_taken_apart(spark):
    """A batch is Python objects a few MB at a time, and each text weighs what it weighs alone."""
    texts = pa.array(["word " * 200_000] * 12 + [None, ""])
    parts = list(common.slices(texts))
    assert sum(map(len, parts)) == len(texts) and max(part.nbytes for part in parts) <= common.SLICE
    assert list(common.slices(pa.array([], pa.string()))) == []
    ratios = -np.random.default_rng(4).random(1 << quality.BUCKET_BITS)
    rows = [(k, None if k % 50 == 7 else f"word{k} " * (40_000 if k % 9 == 0 else 3)) for k in range(100)]
    weighed = spark.createDataFrame(rows, "id int, text string").coalesce(1) \
        .select("id", quality.Model(ratios, 1.0).log_weight("text").alias("weight")).collect()
    assert dict(map(tuple, weighed)) == {k: float(ratios[quality.Features().buckets(text)].sum()) for k, text in rows}


def test_query_is_repeatable(spark):
    run = queries.queries()["op8_quality"]
    once, again = (sorted(tuple(r) for r in run(spark, "/root/testdata/sf0.001").collect()) for _ in range(2))
    assert once == again and once
