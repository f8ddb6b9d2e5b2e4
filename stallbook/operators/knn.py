"""The nearest rows of every row of a seed table: blocks of seeds against blocks of vectors as matrix products.

Seeds come in turns of bounded size, which every task gets whole. A task multiplies its vectors with them, a block at a
time, and keeps the ``k`` best per seed, so what leaves a task does not depend on how many vectors it read. A matrix
product only picks the candidates: its last digits depend on where a row lies in its block, so a candidate's
distance is worked out again by itself before it is compared, and ties go to the smaller key. That is done for a
bounded number of candidates at a time, however many a block has.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook.functions.vectors import METRICS
from stallbook.operators.ordered import top_per_group
from stallbook.sources.shared import pinned

TURN_BYTES = 32 << 20       # of seeds that a task holds
PAIR_BYTES = 4 << 20        # of the candidates whose distances are worked out at once, on either side
_SEEDS, _ROWS = 1024, 1024  # of one product
_NEAR = 1e-9                # a product's error, relative to the lengths


def _clean(vector) -> bool:
    return vector is not None and None not in vector and bool(np.isfinite(np.asarray(vector, float)).all())


def _exact(metric: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of paired rows, each summed up by itself."""
    if metric == "l2":
        return np.sqrt(np.square(a - b).sum(axis=1))
    dot = (a * b).sum(axis=1)
    if metric == "inner_product":
        return -dot
    return 1 - dot / (np.sqrt(np.square(a).sum(axis=1)) * np.sqrt(np.square(b).sum(axis=1)))


def _rough(metric: str, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All distances between two blocks by one product, and how far off they may be."""
    dot = a @ b.T
    long_a, long_b = np.linalg.norm(a, axis=1)[:, None], np.linalg.norm(b, axis=1)[None]
    if metric == "inner_product":
        return -dot, _NEAR * (long_a * long_b)
    if metric == "l2":
        squared = long_a ** 2 + long_b ** 2 - 2 * dot
        return np.sqrt(np.maximum(squared, 0)), np.sqrt(_NEAR) * (long_a + long_b)
    return 1 - dot / (long_a * long_b), np.broadcast_to(_NEAR, dot.shape)


class _Best:
    """The ``k`` best rows seen so far of each seed of one dimension."""

    def __init__(self, places: np.ndarray, seeds: np.ndarray, k: int, metric: str) -> None:
        self.places, self.seeds, self.k, self.metric = places, seeds, k, metric
        self.bound = np.full(len(seeds), np.inf)
        # By block of seeds: seed, distance, key.
        self.found: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def see(self, keys: np.ndarray, rows: np.ndarray) -> None:
        step = max(1, PAIR_BYTES // (8 * max(1, rows.shape[1])))
        for start in range(0, len(self.seeds), _SEEDS):
            seeds = self.seeds[start:start + _SEEDS]
            apart, error = _rough(self.metric, seeds, rows)
            near = self.bound[start:start + _SEEDS]
            if self.k <= len(rows):
                # No farther than the k-th of this block can be; an overflow, which is no number, says nothing.
                near = np.fmin(near, np.partition(apart + error, self.k - 1, axis=1)[:, self.k - 1])
            who, what = np.nonzero(apart - error <= near[:, None])
            del apart, error
            for first in range(0, len(who), step):
                some, of = who[first:first + step], what[first:first + step]
                self._keep(start, start + some, _exact(self.metric, seeds[some], rows[of]), keys[of])

    def _keep(self, block: int, who: np.ndarray, apart: np.ndarray, keys: np.ndarray) -> None:
        found = self.found.get(block)
        if found is not None:
            again = np.isin(found[0], who)
            rest = tuple(part[~again] for part in found)
            who, apart, keys = (np.concatenate([new, part[again]]) for new, part in zip((who, apart, keys), found))
        order = np.lexsort((keys, apart, who))
        who, apart, keys = who[order], apart[order], keys[order]
        first = np.r_[0, np.flatnonzero(np.diff(who)) + 1]
        rank = np.arange(len(who)) - np.repeat(first, np.diff(np.r_[first, len(who)]))
        last = rank == self.k - 1
        self.bound[who[last]] = apart[last]
        kept = rank < self.k
        who, apart, keys = who[kept], apart[kept], keys[kept]
        if found is not None:
            who, apart, keys = (np.concatenate(pair) for pair in zip(rest, (who, apart, keys)))
        self.found[block] = who, apart, keys


def nearest_to_each(df: DataFrame, seeds: DataFrame, k: int = 5, metric: str = "cosine", key: str = "order_id",
                    vector: str = "embedding", turn_bytes: int = TURN_BYTES) -> DataFrame:
    """(seed, key, distance, position): the ``k`` rows of ``df`` closest to each row of ``seeds``, from 1 on.

    ``key`` is a number or text. Rows without a distance to a seed are left out: other lengths, null or non-finite
    components, and length zero where the cosine is asked for. A seed that repeats gets its rows each time.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; choose one of {METRICS}")
    given = pinned(seeds.where(F.col(vector).isNotNull()).select(
        F.monotonically_increasing_id().alias("place"), F.col(key).alias("seed"), F.col(vector).alias("vector")))
    size = given.agg(F.count("*").alias("rows"), F.max(F.size("vector")).alias("widest")).first()
    if not size["rows"]:
        size = {"rows": 0, "widest": 1}
    per_turn = max(1, turn_bytes // (8 * max(size["widest"], 1)))
    turns = max(1, -(-size["rows"] // per_turn))
    dealt = given.withColumn("turn", F.pmod(F.xxhash64("place"), F.lit(turns)))
    while turns > 1 and dealt.groupBy("turn").count().agg(F.max("count")).first()[0] > 2 * per_turn:
        turns *= 2
        dealt = given.withColumn("turn", F.pmod(F.xxhash64("place"), F.lit(turns)))
    parts = [_turn(df, dealt.where(F.col("turn") == turn), k, metric, key, vector) for turn in range(turns)]
    # Each turn is written before the next one's seeds are fetched.
    found = reduce(DataFrame.unionByName, [pinned(part) for part in parts])
    best = top_per_group(found, ["place"], [F.col("distance").asc(), F.col("key").asc()], k)
    return best.join(given.select("place", "seed"), "place").select(
        "seed", F.col("key").alias(key), "distance", F.col("position").cast("long").alias("position"))


def _turn(df: DataFrame, seeds: DataFrame, k: int, metric: str, key: str, vector: str) -> DataFrame:
    """The best of each task for one turn of seeds, which are few enough to be fetched."""
    by_size: dict[int, list] = {}
    for row in seeds.select("place", "vector").collect():
        if _clean(row["vector"]) and (metric != "cosine" or any(row["vector"])):
            by_size.setdefault(len(row["vector"]), []).append(row)
    sent = df.sparkSession.sparkContext.broadcast({
        size: (np.array([r["place"] for r in rows]), np.array([r["vector"] for r in rows], float))
        for size, rows in by_size.items()})
    type_ = df.schema[key].dataType
    schema = T.StructType([T.StructField("place", T.LongType()), T.StructField("key", type_),
                           T.StructField("distance", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {size: _Best(*part, k, metric) for size, part in sent.value.items()}
        arrow = None
        for batch in batches:
            arrow = batch.schema.field(0).type
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                rows: dict[int, list] = {}
                for name, found in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if name is not None and _clean(found) and len(found) in best and (metric != "cosine" or any(found)):
                        rows.setdefault(len(found), []).append((name, found))
                for size, some in rows.items():
                    names = [name for name, _ in some]
                    keys = np.array(names, object if isinstance(names[0], str) else None)
                    best[size].see(keys, np.array([v for _, v in some], float))
        for kept in best.values():
            for who, apart, keys in kept.found.values():
                yield pa.RecordBatch.from_arrays([pa.array(kept.places[who]), pa.array(list(keys), arrow), pa.array(apart)],
                                                 ["place", "key", "distance"])

    return df.where(F.col(vector).isNotNull()).select(key, vector).mapInArrow(run, schema)
