import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallbook.functions import vectors
from stallbook.operators import embedding, search
from stallbook.plans import embed_reviews, questions

SCHEMA = "order_id string, embedding array<float>"


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_distances(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0])], "a array<float>, b array<float>")
    found = df.select(*[vectors.distance(m, F.col("a"), F.col("b")) for m in vectors.METRICS]).first()
    assert list(found) == pytest.approx([1 - 24 / 25, math.sqrt(2), -24.0])
    with pytest.raises(ValueError):
        vectors.distance("hamming", F.col("a"), F.col("b"))


def test_nearest_leaves_out_rows_without_a_distance(spark):
    df = spark.createDataFrame([("seed", [1.0, 0.0]), ("near", [2.0, 0.1]), ("far", [-1.0, 0.0]), ("none", None),
                                ("zero", [0.0, 0.0]), ("short", [1.0])], SCHEMA)
    assert [r[0] for r in rows(search.nearest(df, "seed", k=5))] == ["seed", "near", "far"]
    assert [r[0] for r in rows(search.nearest(df, "seed", k=2))] == ["seed", "near"]
    assert [r[0] for r in rows(search.nearest(df, "seed", k=5, metric="l2"))] == ["seed", "zero", "near", "far"]
    assert rows(search.nearest(df, "none", k=5)) == []
    assert rows(search.nearest(df, "unknown", k=5)) == []


def test_two_seeds_are_an_error(spark):
    df = spark.createDataFrame([("seed", [1.0]), ("seed", [2.0])], SCHEMA)
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        search.nearest(df, "seed").collect()


def test_nearest_equals_brute_force(spark):
    rng = np.random.default_rng(7)
    data = rng.normal(size=(200, 16)).astype("float32")
    df = spark.createDataFrame([(f"v{i:03}", [float(x) for x in v]) for i, v in enumerate(data)], SCHEMA).repartition(5)
    unit = data.astype("float64") / np.linalg.norm(data.astype("float64"), axis=1, keepdims=True)
    want = [f"v{i:03}" for i in np.argsort(1 - unit @ unit[17], kind="stable")[:10]]
    assert [r[0] for r in rows(search.nearest(df, "v017", k=10))] == want


REVIEWS = "order_id string, review_comment_message string"


def test_pending(spark):
    reviews = spark.createDataFrame([("d", "x" * 20), ("c", "x" * 19), ("b", None), ("a", "é" * 20), ("e", "y" * 30)], REVIEWS)
    vectors_ = spark.createDataFrame([("e", [1.0]), ("d", None)], SCHEMA)
    assert [r[0] for r in rows(embedding.pending(reviews, vectors_))] == ["a", "d"]
    assert [r[0] for r in rows(embedding.pending(reviews, vectors_, limit=1))] == ["a"]
    assert embedding.pending(reviews, vectors_, limit=None).count() == 2


def test_embedding_goes_on_until_nothing_is_left(spark, typed, tmp_path):
    path = str(tmp_path / "vectors")
    reviews = typed["order_reviews"]
    assert [embed_reviews.embed_reviews(reviews, path, limit=2) for _ in range(4)] == [2, 4, 4, 4]
    read = embedding.with_embedding(reviews, embed_reviews.read_vectors(spark, path))
    assert read.count() == 7 and embedding.embedded_count(read).first()[0] == 4
    # Orders 4 and 5 carry the same text, so each is the other's nearest.
    found = rows(questions.nearest_reviews(reviews, embed_reviews.read_vectors(spark, path), "o4", k=2))
    assert found == [("r7", "very good product and seller")] * 2


def test_embed_batches_rounds_and_checks(spark):
    texts = spark.createDataFrame([(f"k{i:03}", f"text number {i}") for i in range(250)], REVIEWS).coalesce(1)

    def sizes(batch):
        assert len(batch) <= 96
        return [[1 / 3, float(len(batch))] for _ in batch]

    found = rows(embedding.embed(texts, sizes, dim=2))
    assert len(found) == 250 and all(v[0] == float(np.float32(0.333333)) for _, v in found)
    assert sorted({v[1] for _, v in found}) == [58.0, 96.0]

    def one_short(batch):
        return [[0.0, 1.0]] * (len(batch) - 1) + [[0.0]]

    with pytest.raises(Exception, match="expected length 2"):
        embedding.embed(texts, one_short, dim=2).collect()


def test_a_vector_without_its_review_takes_no_place(spark):
    vectors_ = spark.createDataFrame([("a", [1.0, 0.0]), ("gone", [1.0, 0.0]), ("b", [0.0, 1.0])], SCHEMA)
    reviews = spark.createDataFrame([("a", "r1", "x"), ("b", "r2", None)], "order_id string, review_id string, review_comment_message string")
    assert rows(questions.nearest_reviews(reviews, vectors_, "a", k=2)) == [("r1", "x"), ("r2", None)]


def test_sample_shuffles_keys_only(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
        known = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").withColumnRenamed("vec_id", "doc_id")
        found = embedding.pending(documents, known, key="doc_id", text="text", limit=5)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    anti = plan[plan.index("LeftAnti"):]
    assert "Project [doc_id" in anti and "LeftSemi" in plan


def test_hashed_tokens_is_deterministic_and_unit():
    model = embedding.hashed_tokens(64)
    a, b, empty = model(["Bom produto", "bom PRODUTO!", "?!"])
    assert np.array_equal(a, b) and np.linalg.norm(a) == pytest.approx(1.0) and not empty.any()


def test_updates(spark):
    old = spark.createDataFrame([("a", [1.0]), ("b", [2.0]), ("c", None)], SCHEMA)
    new = spark.createDataFrame([("b", [9.0]), ("c", [8.0]), ("z", [7.0])], SCHEMA)
    assert sorted(rows(embedding.update_by_key(old, new, "order_id", "embedding"))) == [
        ("a", [1.0]), ("b", [9.0]), ("c", [8.0])]
    assert sorted(rows(embedding.upsert_vectors(old, new))) == [
        ("a", [1.0]), ("b", [9.0]), ("c", [8.0]), ("z", [7.0])]
