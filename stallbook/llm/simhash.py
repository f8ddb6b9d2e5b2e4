"""SimHash near-duplicates: fingerprints of word shingles, joined by walking a binary trie with itself."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.llm.common import components, joined_forest, map_rows
from stallbook.sources.shared import pinned

BITS = 64
STEP = 4               # bits by which Spark deepens the trie's upper part
SUBTREE = 4096         # fingerprints a subtree may hold before Spark splits it further
BATCH = 1 << 16        # fingerprints that a task walks at once, but for a node that goes over
CHUNK = 1 << 18        # node pairs, or shingles, held at once in a task


def fingerprint(text: str | None, width: int = 3) -> int:
    """SimHash of a whole text as an unsigned 64-bit number.

    A-Z are lowered, words are what lies between ASCII white space, shingles are ``width`` words joined by one
    space, repeats included; a shorter text is one shingle, a text without words gives zero. Each shingle's XXH64
    (UTF-8, seed 42) votes for its bits; a bit is set by more than half of the votes.
    """
    import xxhash

    words = (text or "").encode().lower().split()   # bytes: only ASCII letters and white space
    if not words:
        return 0
    line = b" ".join(words)
    count = max(1, len(words) - width + 1)
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(word) + 1 for word in words], out=starts[1:])
    begins = starts[:count].tolist()
    ends = (starts[-count:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(BITS, np.int64)
    for first in range(0, count, CHUNK):
        part = zip(begins[first:first + CHUNK], ends[first:first + CHUNK])
        hashes = np.fromiter((digest(line[a:b], 42) for a, b in part), ">u8")
        votes += np.unpackbits(hashes.view(np.uint8)).reshape(-1, BITS).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > count).tobytes(), "big")


def fingerprints(documents: DataFrame, width: int = 3, id_column: str = "doc_id", text_column: str = "text",
                 carry: Sequence[str] = ()) -> DataFrame:
    """(id, *carry, fp) per row; ``fp`` holds the fingerprint's 64 bits as a long. Null text counts as empty."""
    kinds = ["id " + documents.schema[id_column].dataType.simpleString(),
             *(f"{name} {documents.schema[name].dataType.simpleString()}" for name in carry)]

    def rows(texts: list, *others: list) -> Iterator[tuple]:
        for text, *values in zip(texts, *others):
            value = fingerprint(text, width)
            yield *values, value - (1 << BITS) if value >> (BITS - 1) else value

    return map_rows(documents.select(text_column, id_column, *carry), ", ".join([*kinds, "fp long"]), rows)


def _prefix(depth: int) -> Column:
    return F.shiftrightunsigned("v", BITS - depth)


def _rotated(value: Column, bits: int, by: Column) -> Column:
    """``value`` with its lowest ``bits`` bits rotated to the left; the others stay."""
    mask = F.lit((1 << bits) - 1 if bits < BITS else -1)
    low = value.bitwiseAND(mask)
    turned = F.call_function("shiftleft", low, by).bitwiseOR(F.call_function("shiftrightunsigned", low, F.lit(bits) - by))
    # A shift by as many bits as there are leaves the value as it is, so a rotation by none is taken apart.
    turned = F.when(by == 0, low).otherwise(turned.bitwiseAND(mask))
    return value.bitwiseAND(F.lit(~((1 << bits) - 1) if bits < BITS else 0)).bitwiseOR(turned)


def _turned(rows: DataFrame, depth: int, radius: int) -> tuple[DataFrame, int]:
    """Each row ``radius + 1`` times, with another block of the bits below ``depth`` next, and the depth behind it.

    Two values within the radius agree wholly in one of so many blocks, so they share a node at that depth in one of
    the turns, however deep it is.
    """
    width = (BITS - depth) // (radius + 1)
    turns = rows.withColumn("next", F.explode(F.sequence(F.lit(0), F.lit(radius))))
    turned = turns.select((F.col("turn") * (radius + 1) + F.col("next")).alias("turn"),
                          _rotated(F.col("v"), BITS - depth, F.col("next") * width).alias("v"), "fp")
    return turned, depth + width


def _crowded(rows: DataFrame, depth: int) -> DataFrame:
    """(turn, node) of the nodes at ``depth`` that hold more than a task should join at once."""
    nodes = rows.groupBy("turn", _prefix(depth).alias("node")).count()
    return pinned(nodes.where(F.col("count") > SUBTREE).select("turn", "node"))


def _frontier(rows: DataFrame, roots: DataFrame, depth: int, radius: int) -> list[tuple[int, DataFrame]]:
    """Pairs of subtrees within ``radius`` bits of each other below ``roots``, as (depth, DataFrame turn, a, b).

    Node pairs are deepened together by STEP bits; the differing bits of their prefixes are the errors so far, and
    a pair with more than ``radius`` goes. A pair is handed out once both subtrees are small, so a crowded part of
    the trie is split deeper than the rest.
    """
    pairs = roots.select("turn", F.col("node").alias("a"), F.col("node").alias("b"))
    handed_out = []
    while depth < BITS:
        step = min(STEP, BITS - depth)
        depth += step
        nodes = pinned(rows.groupBy("turn", _prefix(depth).alias("node")).count())
        nodes = nodes.withColumn("parent", F.shiftrightunsigned("node", step))
        left = nodes.select("turn", F.col("node").alias("x"), F.col("count").alias("nx"), F.col("parent").alias("a"))
        right = nodes.select("turn", F.col("node").alias("y"), F.col("count").alias("ny"), F.col("parent").alias("b"))
        deeper = pairs.join(left, ["turn", "a"]).join(right, ["turn", "b"])
        # Within one subtree each pair of children comes up twice; across subtrees once.
        deeper = deeper.where((F.col("a") != F.col("b")) | (F.col("x") <= F.col("y")))
        deeper = pinned(deeper.where(F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= radius))
        heavy = (F.greatest("nx", "ny") > SUBTREE) if depth < BITS else F.lit(False)
        handed_out.append((depth, deeper.where(~heavy).select("turn", F.col("x").alias("a"), F.col("y").alias("b"))))
        pairs = deeper.where(heavy).select("turn", F.col("x").alias("a"), F.col("y").alias("b"))
        if pairs.isEmpty():
            break
    return handed_out


def _levels(values: np.ndarray, depth: int) -> list[np.ndarray]:
    """For each depth from ``depth`` to BITS: where its nodes begin in the sorted values, and the end."""
    levels = []
    for d in range(depth, BITS + 1):
        prefixes = values >> np.uint64(BITS - d) if d else np.zeros(len(values), np.uint64)
        starts = np.flatnonzero(np.r_[True, prefixes[1:] != prefixes[:-1]])
        levels.append(np.r_[starts, len(values)])
    return levels


def trie_pairs(a: np.ndarray, b: np.ndarray, roots: list[tuple[int, int]], depth: int,
               radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of all pairs within ``radius`` bits below the node pairs ``roots``.

    ``a`` and ``b`` are sorted and distinct; ``roots`` are pairs of nodes, numbered along the arrays, at ``depth``.
    Both tries are walked together, one bit at a time. The bits that the two prefixes differ in are the errors so
    far; a pair that has spent more than ``radius`` goes. Two single leaves are compared at once.
    """
    in_a, in_b = _levels(a, depth), _levels(b, depth)
    pending = [(depth, *map(np.asarray, zip(*roots)))] if roots else []
    while pending:
        d, x, y = pending.pop()
        if len(x) > CHUNK:
            pending += [(d, x[k:k + CHUNK], y[k:k + CHUNK]) for k in range(0, len(x), CHUNK)]
            continue
        la, lb = in_a[d - depth], in_b[d - depth]
        single = (la[x + 1] - la[x] == 1) & (lb[y + 1] - lb[y] == 1)
        i, j = la[x[single]], lb[y[single]]
        near = np.bitwise_count(a[i] ^ b[j]) <= radius
        yield i[near], j[near]
        x, y = x[~single], y[~single]
        if not len(x) or d == BITS:
            continue
        # A node's children are the nodes of the next level that begin inside it: one or two.
        na, nb = in_a[d + 1 - depth], in_b[d + 1 - depth]
        x0, x1 = np.searchsorted(na, la[x]), np.searchsorted(na, la[x + 1])
        y0, y1 = np.searchsorted(nb, lb[y]), np.searchsorted(nb, lb[y + 1])
        deeper = []
        for dx in (0, 1):
            for dy in (0, 1):
                there = (x0 + dx < x1) & (y0 + dy < y1)
                cx, cy = x0[there] + dx, y0[there] + dy
                spent = np.bitwise_count((a[na[cx]] ^ b[nb[cy]]) >> np.uint64(BITS - d - 1))
                deeper.append((cx[spent <= radius], cy[spent <= radius]))
        x, y = (np.concatenate(part) for part in zip(*deeper))
        if len(x):
            pending.append((d + 1, x, y))


def _forest(values: np.ndarray, prints: np.ndarray, other: np.ndarray | None, other_prints: np.ndarray | None,
            roots: list[tuple[int, int]], depth: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints that a walk from ``roots`` links, as a spanning forest: (fingerprint, its tree's first)."""
    both = prints if other is None else np.concatenate([prints, other_prints])
    shift = 0 if other is None else len(prints)
    labels = np.arange(len(both))
    for i, j in trie_pairs(values, values if other is None else other, roots, depth, radius):
        joined_forest(labels, i, j + shift)
    moved = np.flatnonzero(labels != np.arange(len(both)))
    return both[moved], both[labels[moved]]


def _joined_nodes(rows: DataFrame, depth: int, radius: int) -> DataFrame:
    """Links inside each node at ``depth``, none of them crowded: a task walks many at once, in bounded batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def walked(values: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
            order = np.argsort(values)
            values, prints = values[order], prints[order]
            nodes = len(np.unique(values >> np.uint64(BITS - depth))) if depth else 1
            a, b = _forest(values, prints, None, None, [(k, k) for k in range(nodes)], depth, radius)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        # Rows come by turn and node; what is held is walked as far as the last node that is complete.
        held: list[tuple] = []
        size = 0
        for batch in batches:
            held.append(tuple(column.to_numpy() for column in batch.columns))
            size += batch.num_rows
            if size < BATCH:
                continue
            turn, node, v, fp = (np.concatenate(parts) for parts in zip(*held))
            open_from = int(np.flatnonzero((turn != turn[-1]) | (node != node[-1]))[-1]) + 1 \
                if (turn[0], node[0]) != (turn[-1], node[-1]) else 0
            for t in np.unique(turn[:open_from]):
                mine = np.flatnonzero(turn[:open_from] == t)
                yield walked(v[mine].view(np.uint64), fp[mine])
            held, size = [(turn[open_from:], node[open_from:], v[open_from:], fp[open_from:])], len(turn) - open_from
        if size:
            turn, node, v, fp = (np.concatenate(parts) for parts in zip(*held))
            for t in np.unique(turn):
                mine = np.flatnonzero(turn == t)
                yield walked(v[mine].view(np.uint64), fp[mine])

    placed = rows.select("turn", _prefix(depth).alias("node"), "v", "fp")
    return placed.repartition("turn", "node").sortWithinPartitions("turn", "node").mapInArrow(run, "a long, b long")


def _joined_pairs(rows: DataFrame, pairs: DataFrame, depth: int, radius: int) -> DataFrame:
    """Links between the two nodes of each pair. Neither is crowded, and each pair is a group of its own."""
    prefixed = rows.select("turn", _prefix(depth).alias("node"), "v", "fp")

    def side(which: str, some: DataFrame) -> DataFrame:
        found = some.join(prefixed.withColumnRenamed("node", which), ["turn", which])
        return found.select("turn", "a", "b", F.lit(which == "b").alias("other"), "v", "fp")

    def joined(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(u=group.v.to_numpy().view(np.uint64)).sort_values("u")
        mine, other = group[~group.other], group[group.other]
        same = not len(other)
        a, b = _forest(mine.u.to_numpy(), mine.fp.to_numpy(), None if same else other.u.to_numpy(),
                       None if same else other.fp.to_numpy(), [(0, 0)], depth, radius)
        return pd.DataFrame({"a": a, "b": b})

    given = side("a", pairs).unionByName(side("b", pairs.where("a <> b")))
    return given.groupBy("turn", "a", "b").applyInPandas(joined, "a long, b long")


def links(distinct: DataFrame, radius: int = 3) -> DataFrame:
    """(a, b) fingerprints whose links span every group of fingerprints within ``radius`` bits.

    The trie is built once for each of ``radius + 1`` orders of the bits, with another block of them on top each time.
    A pair within the radius spends nothing on one of these blocks, so every order only joins each node below its top
    block with itself, and a fingerprint travels ``radius + 1`` times however many there are. A crowded node does the
    same again with the bits that are left; where that is crowded too, node pairs are deepened one by one. Each walk
    returns a spanning forest: at most one row per fingerprint it was given, however dense a group is. No link is
    lost to reachability.
    """
    rows = distinct.select(F.lit(0).alias("turn"), F.col("fp").alias("v"), "fp")
    depth, found = 0, []
    for _ in range(2):
        if (BITS - depth) // (radius + 1) == 0:
            break
        rows, depth = _turned(rows, depth, radius)
        crowded = _crowded(rows, depth)
        place = ["turn", "node"]
        placed = rows.withColumn("node", _prefix(depth))
        found.append(_joined_nodes(placed.join(crowded, place, "left_anti"), depth, radius))
        if crowded.isEmpty():
            return reduce(DataFrame.unionAll, found)
        rows = pinned(placed.join(crowded, place, "left_semi").drop("node"))
    roots = rows.select("turn", _prefix(depth).alias("node")).distinct()
    found += [_joined_pairs(rows, pairs, at, radius) for at, pairs in _frontier(rows, roots, depth, radius)]
    return reduce(DataFrame.unionAll, found)


def near_duplicates(documents: DataFrame, width: int = 3, radius: int = 3, id_column: str = "doc_id",
                    text_column: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """(id, *carry, fingerprint, component_id, group_print) per row of ``documents``; ``carry`` names columns to keep.

    Documents link when their fingerprints differ in at most ``radius`` bits; the component is the smallest id that
    links reach. Equal fingerprints are one node of the join, however many documents share them. Null and empty
    texts have fingerprint zero and link like any other; a repeated row repeats its result; null ids are never the
    smallest unless a component has no other; an empty table gives an empty result. ``group_print``, one fingerprint of
    the component, tells components apart also where ids repeat and two components have the same smallest id.
    """
    each = pinned(fingerprints(documents, width, id_column, text_column, carry))
    distinct = pinned(each.groupBy("fp").agg(F.min("id").alias("first")))
    groups = components(links(distinct.select("fp"), radius))
    mapped = distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left")
    mapped = pinned(mapped.select("fp", "first", F.coalesce("component", "fp").alias("root")))
    smallest = mapped.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = pinned(mapped.join(smallest, "root").select("fp", "component_id", "root"))

    def digits(column: str) -> Column:
        return F.lower(F.lpad(F.hex(column), 16, "0"))

    return each.join(by_print, "fp").select(
        "id", *carry, digits("fp").alias("fingerprint"), "component_id", digits("root").alias("group_print"))
