"""Exact nearest rows with data skipping: stored distances to pivots, the triangle inequality as pushed ranges.

Every vector is stored with its length and with the distance of its direction to a few fixed directions, the pivots.
The rows are sorted by the pivot nearest to them and that distance, so a file's row groups and pages span narrow
ranges. A search finds an upper bound for the k-th distance among the rows around the seed's own pivot; no row can be
closer than the bound unless its stored distances differ from the seed's by less than a known amount. Those ranges
are filters on stored columns, which Parquet answers from its statistics before it reads a vector.

The result is that of ``search.nearest``. Vectors of another length than the seed's, empty ones and those with a
component that is no number have no stored distances and are always looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook.functions import vectors

PIVOTS = 16
SAMPLE = 4096       # rows the pivots are chosen from
# Stored distances are rounded to 32 bits, and differences of nearly equal directions lose digits: ranges are wider by this.
_SLACK = 1e-5


def _spread(sample: np.ndarray, count: int) -> np.ndarray:
    """Directions far apart: each the one of the sample farthest from those before it."""
    length = np.linalg.norm(sample, axis=1)
    usable = np.isfinite(length) & (length > 0)
    unit = sample[usable] / length[usable, None]
    if not len(unit):
        return np.zeros((0, sample.shape[1]))
    chosen = [0]
    nearest = np.full(len(unit), np.inf)
    while len(chosen) < min(count, len(unit)):
        nearest = np.minimum(nearest, 2 - 2 * unit @ unit[chosen[-1]])
        chosen.append(int(nearest.argmax()))
    return unit[chosen]


def _to_pivots(directions: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * directions @ pivots.T))


@dataclass(frozen=True)
class PivotIndex:
    """The vectors under ``path``: ``rows`` with their stored distances, and the ``pivots``."""

    spark: SparkSession
    path: str

    @classmethod
    def build(cls, df: DataFrame, path: str, key: str = "order_id", vector: str = "embedding", pivots: int = PIVOTS,
              row_group_bytes: int | None = None) -> PivotIndex:
        """Write the rows of ``df`` that have a vector, sorted for searching. The sort cuts them into ranges, so no task
        needs more than its range. Columns named ``norm``, ``cell`` or ``to_`` and a number are refused."""
        names = ["norm", "cell", *[f"to_{i}" for i in range(pivots)]]
        if clash := set(names) & set(df.columns):
            raise ValueError(f"columns {sorted(clash)} are the index's own")
        rows = df.where(F.col(vector).isNotNull())
        usable = rows.where((F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)))
        sample = [row[vector] for row in usable.orderBy(F.xxhash64(key), key).limit(SAMPLE).select(vector).collect()]
        dimension = max(Counter(map(len, sample)).items(), key=lambda size: size[1], default=(0, 0))[0]
        typical = [v for v in sample if len(v) == dimension]
        chosen = _spread(np.array(typical, float).reshape(len(typical), dimension), pivots)

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                given = batch.column(vector).to_pylist()
                cells = np.full(len(given), -1, np.int32)
                stored = np.full((len(given), pivots), np.nan, np.float32)
                fit = [i for i, v in enumerate(given) if len(v) == dimension and None not in v] if len(chosen) else []
                data = np.array([given[i] for i in fit], float).reshape(len(fit), dimension)
                length = np.linalg.norm(data, axis=1) if len(fit) else np.zeros(0)
                good = np.isfinite(length) & (length > 0)
                at = np.array(fit, int)[good] if len(fit) else np.zeros(0, int)
                if len(at):
                    apart = _to_pivots(data[good] / length[good, None], chosen)
                    cells[at] = apart.argmin(axis=1)
                    stored[at, :len(chosen)] = apart
                columns = [batch.column(i) for i in range(batch.num_columns)]
                columns += [pa.array(cells), *[pa.array(stored[:, i], mask=np.isnan(stored[:, i])) for i in range(pivots)]]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *names[1:]])

        schema = T.StructType([*rows.schema.fields, T.StructField("norm", T.DoubleType()), T.StructField("cell", T.IntegerType()),
                               *[T.StructField(n, T.FloatType()) for n in names[2:]]])
        own = F.get(F.array(*names[2:]), F.col("cell"))
        found = rows.withColumn("norm", vectors.norm(F.col(vector))).mapInArrow(placed, schema)
        ordered = found.repartitionByRange("cell", own, F.xxhash64(key)).sortWithinPartitions("cell", own)
        writer = ordered.write.mode("overwrite")
        if row_group_bytes:
            writer = writer.option("parquet.block.size", row_group_bytes).option("parquet.page.size", row_group_bytes)
        writer.parquet(f"{path}/rows")
        spark = df.sparkSession
        spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(chosen)], "cell int, direction array<double>") \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/pivots")
        return cls(spark, path)

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def nearest(self, seed, k: int = 5, metric: str = "cosine", key: str = "order_id",
                vector: str = "embedding") -> DataFrame:
        """The ``k`` rows closest to the row with ``key = seed``, itself included, as ``search.nearest`` gives them."""
        rows = self.rows()
        found = rows.where(F.col(key) == F.lit(seed)).select(vector, "norm").limit(2).collect()
        if len(found) > 1:
            raise ValueError(f"{key} {seed!r} has more than one vector")
        scored = rows.limit(0).withColumn("distance", F.lit(None).cast("double"))
        if found:
            query = F.array(*[F.lit(x) for x in found[0][vector]])
            where = self._within(rows, found[0], k, metric, key, vector, query)
            scored = _scored(rows.where(where), query, found[0]["norm"], metric, vector)
        extra = [c for c in rows.columns if c in ("norm", "cell") or c.startswith("to_")]
        closest = scored.orderBy(F.col("distance").asc_nulls_last(), F.col(key).asc()).limit(k).drop(*extra)
        return closest.where(F.col("distance").isNotNull() & ~F.isnan("distance"))

    def _within(self, rows: DataFrame, seed, k: int, metric: str, key: str, vector: str, query: Column) -> Column:
        """What the stored columns of the ``k`` nearest rows must fulfil."""
        pivots = [row["direction"] for row in
                  self.spark.read.parquet(f"{self.path}/pivots").orderBy("cell").collect()]
        length, everything = seed["norm"], F.lit(True)
        if not pivots or len(pivots[0]) != len(seed[vector]) or not (length and math.isfinite(length)):
            return everything
        apart = _to_pivots(np.array(seed[vector], float)[None] / length, np.array(pivots))[0]
        near = _scored(rows.where(F.col("cell") == int(apart.argmin())), query, length, metric, vector)
        bound = [row["distance"] for row in near.where(F.col("distance").isNotNull() & ~F.isnan("distance"))
                 .orderBy("distance").limit(k).select("distance").collect()]
        if len(bound) < k:
            return everything
        farthest = bound[-1]
        if metric == "inner_product":
            longest = rows.where("cell >= 0").agg(F.max("norm")).first()[0]
            lengths, chord = _inner_product(farthest, length, longest)
        else:
            lengths, chord = _cosine(farthest) if metric == "cosine" else _l2(farthest, length)
        wanted = F.col("norm").between(*lengths) if lengths else everything
        for i, at in enumerate(apart if chord < 2 else []):
            wanted &= F.col(f"to_{i}").between(F.lit(float(at - chord - _SLACK)).cast("float"),
                                              F.lit(float(at + chord + _SLACK)).cast("float"))
        return wanted | F.col("to_0").isNull()


def _scored(rows: DataFrame, query: Column, length: float, metric: str, vector: str) -> DataFrame:
    distance = vectors.distance(metric, F.col(vector), query.cast("array<double>"), F.lit(length), F.col("norm"))
    return rows.withColumn("distance", distance)


def _cosine(farthest: float) -> tuple[tuple[float, float] | None, float]:
    """Bounds on a row's length and on the chord between directions, from a bound on the distance."""
    return None, math.sqrt(max(0.0, 2 * farthest))


def _l2(farthest: float, length: float) -> tuple[tuple[float, float] | None, float]:
    """Lengths differ by no more than the distance; beyond a tangent's angle nothing is as near."""
    room = farthest * (1 + 1e-9) + 1e-12
    chord = math.sqrt(2 - 2 * math.sqrt(1 - (room / length) ** 2)) if room < length else 2.0
    return (length - room, length + room), chord


def _inner_product(farthest: float, length: float, longest: float) -> tuple[tuple[float, float] | None, float]:
    """A product of at least -``farthest`` needs a length of its own, and the longest rows allow the widest angle."""
    product = -farthest * (1 - 1e-9)
    if product <= 0:
        return None, 2.0
    chord = math.sqrt(max(0.0, 2 - 2 * product / (length * longest)))
    return (product / length * (1 - 1e-9), math.inf), chord
