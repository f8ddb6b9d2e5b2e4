"""Embedding texts in batches, and keeping the vectors in a table of their own."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook.functions.vectors import stored_precision
from stallbook.operators.ordered import sample_in_order

# --- fixed values ------------------------------------------------------------
DIMENSIONS = 1024
TEXTS_PER_CALL = 96
MIN_TEXT_LENGTH = 20
SAMPLE_SIZE = 500

Model = Callable[[Sequence[str]], Sequence[Sequence[float]]]


def hashed_tokens(dimensions: int = DIMENSIONS) -> Model:
    """A model that needs no network: signed token hashes, scaled to length one."""
    def model(texts: Sequence[str]) -> np.ndarray:
        vectors = np.zeros((len(texts), dimensions))
        for row, text in enumerate(texts):
            hashes = np.array([crc32(t.encode()) for t in re.findall(r"\w+", text.lower())], dtype=np.int64)
            np.add.at(vectors[row], (hashes >> 1) % dimensions, np.where(hashes & 1, 1.0, -1.0))
        lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
        return np.divide(vectors, lengths, out=vectors, where=lengths > 0)

    return model


def pending(reviews: DataFrame, vectors: DataFrame, key: str = "order_id", text: str = "review_comment_message",
            min_len: int = MIN_TEXT_LENGTH, limit: int | None = SAMPLE_SIZE) -> DataFrame:
    """The first ``limit`` rows by key with a text worth embedding and no vector yet.

    ``limit=None`` takes them all. A rerun goes on where the last one stopped.
    The sample is chosen by key alone, so that the texts of all the other rows
    need not be shuffled to find it.
    """
    embedded = vectors.where(F.col("embedding").isNotNull()).select(key).distinct()
    worthwhile = reviews.where(F.col(text).isNotNull() & (F.length(text) >= min_len)).select(key, text)
    if limit is None:
        return worthwhile.join(embedded, key, "left_anti")
    chosen = sample_in_order(worthwhile.select(key).join(embedded, key, "left_anti"), key, limit)
    return sample_in_order(worthwhile.join(chosen, key, "left_semi"), key, limit)


def embed(df: DataFrame, model: Model, key: str = "order_id", text: str = "review_comment_message",
          dim: int = DIMENSIONS, batch: int = TEXTS_PER_CALL) -> DataFrame:
    """Vectors of the texts, at most ``batch`` texts per call of ``model``.

    The model runs in the tasks, over the partitions of ``df``. Every vector
    must have ``dim`` components. They are stored to six decimals.
    """
    def vectors_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch):
                rows = frame.iloc[start:start + batch]
                vectors = [[float(x) for x in v] for v in model(rows[text].tolist())]
                lengths = {len(v) for v in vectors}
                if len(vectors) != len(rows) or lengths != {dim}:
                    raise ValueError(f"model gave {len(vectors)} vectors of lengths {sorted(lengths)} "
                                     f"for {len(rows)} texts; expected length {dim}")
                yield pd.DataFrame({key: rows[key].to_numpy(), "embedding": vectors})

    schema = T.StructType([df.schema[key], T.StructField("embedding", T.ArrayType(T.DoubleType()))])
    raw = df.select(key, text).mapInPandas(vectors_of, schema)
    return raw.select(key, stored_precision("embedding").alias("embedding"))


def with_embedding(reviews: DataFrame, vectors: DataFrame, key: str = "order_id") -> DataFrame:
    """Reviews with their vector; NULL means not embedded yet."""
    found = vectors.select(F.col(key).alias("_key"), F.col("embedding").alias("_vector"))
    return (reviews.join(found, F.col(key) == F.col("_key"), "left")
            .withColumn("embedding", F.col("_vector")).drop("_key", "_vector"))


def update_by_key(df: DataFrame, new: DataFrame, key: str, column: str) -> DataFrame:
    """``df`` with ``column`` replaced on the rows whose key is in ``new``.

    The other rows keep their value; keys only in ``new`` add no row.
    """
    updates = new.select(F.col(key).alias("_key"), F.col(column).alias("_new"), F.lit(True).alias("_hit"))
    value = F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(column))
    return (df.join(updates, F.col(key) == F.col("_key"), "left")
            .withColumn(column, value).drop("_key", "_new", "_hit").select(*df.columns))


def upsert_vectors(vectors: DataFrame, new: DataFrame, key: str = "order_id") -> DataFrame:
    """The vector table with ``new`` in it: a key in both takes the new vector."""
    kept = vectors.select(key, "embedding").join(new.select(key), key, "left_anti")
    return kept.unionByName(new.select(key, "embedding"))


def embedded_count(vectors: DataFrame) -> DataFrame:
    """How many rows have a vector."""
    return vectors.agg(F.count("embedding").alias("embedded"))
