"""What several operators share: batches of rows, links to components, splitting of hot groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.sources.shared import pinned


SLICE = 4 << 20     # bytes of an Arrow batch that are Python objects at once, but for a longer row


def slices(rows: pa.RecordBatch | pa.Array) -> Iterator[pa.RecordBatch | pa.Array]:
    """Cut what Arrow hands over into parts of about ``SLICE`` bytes, of one row at least."""
    step = max(1, len(rows) * SLICE // max(1, rows.nbytes))
    for first in range(0, len(rows), step):
        yield rows.slice(first, step)


def map_rows(df: DataFrame, schema: str, function: Callable[..., Iterator[tuple]], rows: int = 1024,
             setup: Callable[[], object] | None = None) -> DataFrame:
    """One Arrow pass: ``function`` gets a batch's columns as lists and yields output rows.

    What ``setup`` makes, once per task, comes before the columns. A batch is taken apart into slices of about
    ``SLICE`` bytes, and output goes back every ``rows`` rows, so neither long texts nor long results are held as
    Python objects all at once.
    """
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(found: list[tuple]) -> pa.RecordBatch:
            columns = zip(*found)
            return pa.RecordBatch.from_arrays(
                [pa.array(column, field.type) for column, field in zip(columns, fields)], schema=fields)

        made = [setup()] if setup else []
        for whole in batches:
            for batch in slices(whole):
                found: list[tuple] = []
                for row in function(*made, *(column.to_pylist() for column in batch.columns)):
                    found.append(row)
                    if len(found) >= rows:
                        yield packed(found)
                        found = []
                if found:
                    yield packed(found)

    return df.mapInArrow(run, schema)


def joined_forest(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Join the sets of ``left[i]`` and ``right[i]`` in place; each label ends as its set's smallest index."""
    while len(left):
        a, b = labels[left], labels[right]
        apart = a != b
        if not apart.any():
            return
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = labels[labels]
            if (further == labels).all():
                break
            labels[:] = further


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links`` (a, b), two columns of any one ordered type without nulls.

    Returns (node, component) for every node that has a link to another; the component is its smallest node.
    Alternates large-star and small-star steps (Kiveris et al., 2014): each is a minimum per node, which is summed
    up inside the map tasks, and a join back, which adaptive execution splits at a node with many links. Every
    round is written to the shared folder, so a lost executor costs at most one round.
    """
    edges = pinned(links.where("a <> b").select("a", "b").distinct())
    while True:
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = pinned(large.where("a <> b").distinct())
        # Each edge now points from the larger node to the smaller.
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionAll(least.select("a", F.col("m").alias("b"))))
        small = pinned(small.where("a <> b").distinct())
        # Done when every node hangs on a root that hangs on nothing.
        if small.select("b").distinct().join(small.select(F.col("a").alias("b")), "b", "left_semi").isEmpty() \
                and small.groupBy("a").count().where("count > 1").isEmpty():
            break
        edges = small
    roots = small.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return small.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)


def text_hash(*columns: str | Column) -> list[Column]:
    """Two 64-bit hashes of the same values: together, other texts with both equal are out of the question."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit(20_011), *columns)]
