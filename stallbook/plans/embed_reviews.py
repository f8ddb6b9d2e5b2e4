"""Growing the vector table, a sample of reviews at a time."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession

from stallbook.operators import embedding
from stallbook.sources.keyed import KeyedTable

VECTOR_SCHEMA = "order_id string, embedding array<float>"
BUCKETS = 64


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """The vector table, empty before the first run."""
    table = KeyedTable(spark, path)
    return table.read() if table.exists() else spark.createDataFrame([], VECTOR_SCHEMA)


def write_back(vectors: DataFrame, path: str, key: str = "order_id", buckets: int = BUCKETS) -> None:
    """Put fresh vectors into the table, which is made if need be; other buckets' files stay as they are."""
    table = KeyedTable(vectors.sparkSession, path)
    if table.exists():
        table.merge(vectors)
    else:
        KeyedTable.create(vectors, path, key, buckets)


def embed_reviews(reviews: DataFrame, path: str, model: embedding.Model | None = None,
                  limit: int | None = embedding.SAMPLE_SIZE, dim: int = embedding.DIMENSIONS) -> int:
    """Embed the next ``limit`` reviews that need it; returns how many have a vector now."""
    spark = reviews.sparkSession
    todo = embedding.pending(reviews, read_vectors(spark, path), limit=limit)
    if limit is not None:
        # A sorted sample is one partition: deal it out, so that calls run side by side.
        calls = ceil(limit / embedding.TEXTS_PER_CALL)
        todo = todo.repartition(max(1, min(calls, spark.sparkContext.defaultParallelism)))
    write_back(embedding.embed(todo, model or embedding.hashed_tokens(dim), dim=dim), path)
    return embedding.embedded_count(read_vectors(spark, path)).first()["embedded"]
