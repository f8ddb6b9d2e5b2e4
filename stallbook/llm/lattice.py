"""Embedding near-duplicates by lattice hashing: projections decoded to E8 points, with probes of nearby points.

Each table projects the unit vectors to eight dimensions, shifts them and takes the nearest point of the E8 lattice
as the cell. A vector lies in its own cell and also looks into the neighbouring cells nearest to it; whatever meets
in a cell is compared by cosine. Vectors of different labels never meet.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.llm.common import components, joined_forest, text_hash
from stallbook.sources.shared import pinned

TABLES = 6
PROBES = 4
SPREAD = 0.58      # lattice units that two vectors at the threshold are expected to lie apart
TILE = 2048        # rows of a cell compared with each other in one task; larger cells are cut into blocks of these
ROWS = 512         # rows of a comparison at a time


def _minimal_vectors() -> np.ndarray:
    """The 240 points of E8 next to zero."""
    whole = [v for v in itertools.product((-1, 0, 1), repeat=8) if sum(map(abs, v)) == 2]
    half = [v for v in itertools.product((-0.5, 0.5), repeat=8) if sum(v) % 2 == 0]
    return np.array(whole + half)


NEIGHBOURS = _minimal_vectors()


def nearest_point(x: np.ndarray) -> np.ndarray:
    """The E8 point nearest to each row: the nearer of the best in D8 and the best in D8 shifted by a half."""
    def even(y: np.ndarray) -> np.ndarray:
        whole = np.rint(y)
        off = y - whole
        worst = np.abs(off).argmax(1)
        rows = np.arange(len(y))
        whole[rows, worst] += np.where(whole.sum(1) % 2 != 0, np.where(off[rows, worst] >= 0, 1.0, -1.0), 0.0)
        return whole

    a, b = even(x), even(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


def _keys(points: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """64-bit hashes of lattice points (..., 8); points of other labels, tables or lengths have another salt."""
    # Mixed first: neighbouring salts must not meet when small coordinates come in.
    found = np.broadcast_to(salt, points.shape[:-1]) * np.uint64(0xD6E8FEB86659FD93)
    found ^= found >> np.uint64(32)
    found *= np.uint64(0xD6E8FEB86659FD93)
    for k in range(8):
        found = (found ^ (2 * points[..., k]).astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(29)
    return found.view(np.int64)


def cells(unit: np.ndarray, salt: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Own cells (n, TABLES) and probed cells (n, TABLES, PROBES) of unit vectors."""
    size = max(8, unit.shape[1])
    unit = np.pad(unit, ((0, 0), (0, size - unit.shape[1])))
    scale = SPREAD / math.sqrt((2 - 2 * threshold) * 8 / size)
    own, probed = [], []
    for table in range(TABLES):
        generator = np.random.default_rng([20_041, table, size])
        frame = np.linalg.qr(generator.normal(size=(size, 8)))[0]
        x = unit @ frame * scale + generator.random(8)
        point = nearest_point(x)
        nearer = np.argsort(-((x - point) @ NEIGHBOURS.T), axis=1, kind="stable")[:, :PROBES]
        mine = salt + np.uint64(table + 1)
        own.append(_keys(point, mine))
        probed.append(_keys(point[:, None, :] + NEIGHBOURS[nearer], mine[:, None]))
    return np.stack(own, 1), np.stack(probed, 1)


def _hashed(vectors: DataFrame, threshold: float, with_vectors: bool) -> DataFrame:
    """A row for each cell a vector lies in or looks into."""
    fields = "cell long, tbl int, probe boolean, node long, copies long" + \
        (", vector binary, cells binary" if with_vectors else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = batch.to_pandas()
            for _, part in table.groupby(table.vector.map(len)):
                for first in range(0, len(part), 256):
                    yield from packed(part.iloc[first:first + 256])

    def packed(part: pd.DataFrame) -> Iterator[pa.RecordBatch]:
        unit = np.array(part.vector.to_list(), np.float64)
        unit /= np.abs(unit).max(1)[:, None]
        unit /= np.sqrt((unit * unit).sum(1))[:, None]
        salt = part.label_hash.to_numpy(np.int64).view(np.uint64) + np.uint64(1009 * unit.shape[1])
        own, probed = cells(unit, salt, threshold)
        every = np.concatenate([own[:, :, None], probed], 2)       # (rows, tables, 1 + probes)
        n, per = len(unit), TABLES * (1 + PROBES)
        columns = [every.ravel(), np.tile(np.repeat(np.arange(TABLES, dtype=np.int32), 1 + PROBES), n),
                   np.tile(np.arange(1 + PROBES) > 0, n * TABLES), np.repeat(part.node.to_numpy(), per),
                   np.repeat(part.copies.to_numpy(), per)]
        names = ["cell", "tbl", "probe", "node", "copies"]
        if with_vectors:
            columns += [[v for row in unit for v in [row.tobytes()] * per],
                        [v for row in every for v in [row.tobytes()] * per]]
            names += ["vector", "cells"]
        yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names)

    return vectors.select("node", "label_hash", "copies", "vector").mapInArrow(run, fields)


def _meet(key: tuple, group: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """What a cell's vectors find: per node the vectors newly linked with it, and a node that it hangs on."""
    cell, first_block, second_block = key
    table = int(group.tbl.iloc[0])
    node, copies = group.node.to_numpy(), group.copies.to_numpy()
    probe, block = group.probe.to_numpy(bool), group.block.to_numpy()
    vectors = np.frombuffer(b"".join(group.vector), np.float64).reshape(len(group), -1)
    every = np.frombuffer(b"".join(group.cells), np.int64).reshape(len(group), TABLES, 1 + PROBES)
    order = np.argsort(node, kind="stable")
    names, number = np.unique(node, return_inverse=True)
    found, labels = np.zeros(len(names), np.int64), np.arange(len(names))
    rows = np.flatnonzero(block == first_block)
    columns = order if first_block == second_block else order[block[order] == second_block]
    for start in range(0, len(rows), ROWS):
        mine = rows[start:start + ROWS]
        near = vectors[mine] @ vectors[columns].T >= threshold
        near &= ~(probe[mine][:, None] & probe[columns][None, :])
        near &= node[mine][:, None] != node[columns][None, :]
        if first_block == second_block:
            near &= mine[:, None] < columns[None, :]
        i, j = np.nonzero(near)
        i, j = mine[i], columns[j]
        # A pair counts where it meets first: in the first table, and there in the smaller cell.
        own_i, own_j = every[i, :, 0], every[j, :, 0]
        met = (own_i == own_j) | (every[i, :, 1:] == own_j[:, :, None]).any(2) \
            | (every[j, :, 1:] == own_i[:, :, None]).any(2)
        first = met.argmax(1) == table
        i_in_j = (every[j, table, 1:] == own_i[:, table, None]).any(1)
        j_in_i = (every[i, table, 1:] == own_j[:, table, None]).any(1)
        first &= ~(i_in_j & j_in_i) | (np.minimum(own_i[:, table], own_j[:, table]) == cell)
        i, j = i[first], j[first]
        np.add.at(found, number[i], copies[j])
        np.add.at(found, number[j], copies[i])
        joined_forest(labels, number[i], number[j])
    linked = found > 0
    return pd.DataFrame({"node": names[linked], "links": found[linked], "root": names[labels[linked]]})


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, id_column: str = "vec_id",
                    vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept) per row of ``vectors``.

    Two vectors link if their labels are equal, their lengths too, and their cosine is at least ``threshold``, in
    double precision; links below it are never made, and most above it are found (README.md has the measured share).
    Equal vectors of a label are one node of the search, however many there are. Vectors that are null, zero or hold
    null or non-finite numbers, and those with a null label or id, link with nothing. The component is the smallest
    id that links reach; a row is kept if that is its own. Rows with the same id are taken for one node. An empty
    table gives an empty result. Ids need an integer column.
    """
    finite = F.forall(vector_column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col(id_column).isNotNull() & F.col(label_column).isNotNull() & finite
                        & F.exists(vector_column, lambda x: x != 0), F.lit(False))
    h1, h2 = text_hash(label_column, vector_column)
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector"),
                          F.xxhash64(label_column).alias("label_hash"), usable.alias("usable"), h1.alias("h1"),
                          h2.alias("h2"))
    classes = pinned(rows.where("usable").groupBy("h1", "h2").agg(
        F.min("id").alias("node"), F.count("*").alias("copies"), F.first("label_hash").alias("label_hash"),
        F.first("vector").alias("vector")))
    # A cell with one row, or into which vectors only look, holds no pair: most cells are such.
    counts = _hashed(classes, threshold, False).groupBy("cell").agg(
        F.count("*").alias("n"), F.min("probe").alias("only_probes")).where("n > 1 and not only_probes")
    shared = pinned(counts.select("cell", F.ceil(F.col("n") / TILE).cast("int").alias("blocks")))
    dealt = _hashed(classes, threshold, True).join(shared, "cell")
    blocks = F.col("blocks")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node", "probe"), blocks).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    met = dealt.withColumns({"b1": F.least("block", "other"), "b2": F.greatest("block", "other")}) \
        .groupBy("cell", "b1", "b2") \
        .applyInPandas(lambda key, group: _meet(key, group, threshold), "node long, links long, root long")
    met = pinned(met)
    linked = met.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(met.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = classes.select("h1", "h2", "node", "copies").join(linked, "node", "left").join(groups, "node", "left")
    known = known.select("h1", "h2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
                         F.coalesce("component", "node").alias("component"), F.lit(True).alias("usable"))
    found = rows.select("id", "h1", "h2", "usable").join(known, ["h1", "h2", "usable"], "left")
    component = F.coalesce("component", "id")
    return found.select("id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
