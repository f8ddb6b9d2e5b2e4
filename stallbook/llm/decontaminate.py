"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

For every benchmark item, windows of as many words slide over each document. A window is compared with the items of
its size in two steps: their 64-bit SimHashes must lie within RADIUS bits, which an index over BLOCKS blocks of the
fingerprint finds without loss (some block then differs by RADIUS // BLOCKS bits at most), and their word shingles,
weighted by how often they occur, must be similar enough. A window without a shingle of such an item has similarity
zero, so only the others are fingerprinted. An item of fewer words than a shingle has is one shingle of its own width,
and documents are cut into shingles of every width that the items have.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.llm.common import map_rows, text_hash
from stallbook.sources.shared import pinned

WIDTH = 5                     # words per shingle
SIMILARITY = 0.8
RADIUS = 23
BLOCKS = 8                    # of 8 bits
ITEMS = 20_000                # distinct benchmark texts sent to the tasks at once, and
ITEM_CHARACTERS = 32 << 20    # their characters; more are taken in turn
KNOWN_WORDS = 500_000
WINDOWS = 4096                # windows looked up at once, and
PAIRS = 1 << 21               # pairs of a window and an item
_SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_MASKS = np.array([mask for mask in range(256) if mask.bit_count() <= RADIUS // BLOCKS])


class Hashes(dict):
    """64-bit hashes of words: in lower case (ASCII), without signs around them; zero if nothing is left."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= KNOWN_WORDS:
            self.clear()
        core = word.strip(_SIGNS)
        self[word] = found = xxhash.xxh64_intdigest(core, 5) if core else 0
        return found

    def words(self, text: str | None) -> np.ndarray:
        """Hashes of a text's words in order."""
        each = np.array([self[word] for word in (text or "").encode().lower().split()], np.uint64)
        return each[each > 0]


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; the width goes into the hash."""
    if not 0 < width <= len(words):
        return words[:0]
    mixed = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        mixed = (mixed ^ words[k:k + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
    return mixed


def fingerprints(votes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of ``size`` shingles from each start on; ``votes`` are running sums of the shingles' bits."""
    ones = votes[starts + size] - votes[starts]
    return np.packbits(2 * ones > size, axis=1).view(">u8").ravel().astype(np.uint64)


def running_votes(shingles: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(shingles.astype(">u8").view(np.uint8)).reshape(-1, 64)
    return np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, 0, dtype=np.int32)])


@dataclass
class Size:
    """The items of one width and size, and their index: per block, those within RADIUS // BLOCKS bits of each value."""

    items: list[int] = field(default_factory=list)
    prints: np.ndarray | None = None
    offsets: np.ndarray | None = None
    entries: list[np.ndarray] = field(default_factory=list)

    def index(self, prints: list[int]) -> None:
        self.prints = np.array(prints, np.uint64)
        offsets = []
        for block in range(BLOCKS):
            values = (self.prints >> np.uint64(8 * block) & np.uint64(255)).astype(np.int64)
            near = (values[:, None] ^ _MASKS[None, :]).ravel()
            owner = np.repeat(np.arange(len(values)), len(_MASKS))
            order = np.argsort(near, kind="stable")
            self.entries.append(owner[order])
            offsets.append(np.searchsorted(near[order], np.arange(257)))
        self.offsets = np.array(offsets)

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (window, item) within RADIUS bits: looked up by block, then compared whole."""
        pairs = []
        for block in range(BLOCKS):
            values = (prints >> np.uint64(8 * block) & np.uint64(255)).astype(np.int64)
            first, last = self.offsets[block][values], self.offsets[block][values + 1]
            count = last - first
            window = np.repeat(np.arange(len(prints)), count)
            place = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
            pairs.append(window * len(self.prints) + self.entries[block][place])
        window, item = np.divmod(np.unique(np.concatenate(pairs)), len(self.prints))
        close = np.bitwise_count(prints[window] ^ self.prints[item]) <= RADIUS
        return window[close], item[close]


class Benchmark:
    """Items ready to be looked for in documents."""

    def __init__(self, items: list[tuple], similarity: float = SIMILARITY) -> None:
        self.similarity, self.hashes = similarity, Hashes()
        self.keys, self.counts, by_shingle = [], [], {}
        self.sizes: dict[tuple[int, int], Size] = {}     # by the shingles' width and their number
        prints: dict[tuple[int, int], list[int]] = {}
        for key, text in items:
            words = self.hashes.words(text)
            width = min(WIDTH, len(words))
            each = shingles(words, width)
            if not len(each):
                continue
            size = width, len(each)
            self.sizes.setdefault(size, Size()).items.append(len(self.keys))
            prints.setdefault(size, []).append(int(fingerprints(running_votes(each), np.array([0]), len(each))[0]))
            for shingle in set(each.tolist()):
                by_shingle.setdefault(shingle, set()).add(size)
            self.keys.append(key)
            self.counts.append(Counter(each.tolist()))
        for size, found in prints.items():
            self.sizes[size].index(found)
        self.widths = sorted({width for width, _ in self.sizes})
        self.shingles = np.array(sorted(by_shingle), np.uint64)
        self.size_sets = [by_shingle[shingle] for shingle in self.shingles.tolist()]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.shingles >> np.uint64(44)).astype(np.int64)] = True

    def found_in(self, text: str | None) -> dict[int, tuple[float, int]]:
        """For each item found, its number: the best similarity and where that window begins, in words."""
        words = self.hashes.words(text)
        best: dict[int, tuple[float, int]] = {}
        for width in self.widths:
            self._of_width(shingles(words, width), best)
        return best

    def _of_width(self, each: np.ndarray, best: dict) -> None:
        hits = np.flatnonzero(self.maybe[(each >> np.uint64(44)).astype(np.int64)])
        if not len(hits):
            return
        place = np.searchsorted(self.shingles, each[hits])
        real = self.shingles[np.minimum(place, len(self.shingles) - 1)] == each[hits]
        hits, place = hits[real], place[real]
        by_size: dict[tuple[int, int], list[int]] = {}
        for hit, shingle in zip(hits.tolist(), place.tolist()):
            for size in self.size_sets[shingle]:
                by_size.setdefault(size, []).append(hit)
        for size, places in by_size.items():
            self._windows(each, size, np.array(places), best)

    def _windows(self, each: np.ndarray, key: tuple[int, int], hits: np.ndarray, best: dict) -> None:
        """Windows of as many shingles as ``key`` says around the hits; a shorter document is one window."""
        size = key[1]
        length = min(size, len(each))
        changes = np.zeros(len(each) + 1, np.int64)
        np.add.at(changes, np.maximum(hits - length + 1, 0), 1)
        np.add.at(changes, hits + 1, -1)
        starts = np.flatnonzero(np.cumsum(changes)[:len(each) - length + 1] > 0)
        of_size = self.sizes[key]
        # However many items have this size, so many pairs are looked at in one go.
        step = max(1, min(WINDOWS, PAIRS // len(of_size.items)))
        for first in range(0, len(starts), step):
            part = starts[first:first + step]
            low = part[0]
            votes = running_votes(each[low:part[-1] + length])
            window, item = of_size.near(fingerprints(votes, part - low, length))
            for start, number in zip(part[window].tolist(), item.tolist()):
                number = of_size.items[number]
                wanted, have = self.counts[number], Counter(each[start:start + length].tolist())
                both = sum(min(count, have[shingle]) for shingle, count in wanted.items() if shingle in have)
                similar = both / (size + length - both)
                if similar >= self.similarity and (similar, -start) > (best.get(number, (0.0, 0))[0],
                                                                      -best.get(number, (0.0, 0))[1]):
                    best[number] = similar, start


def contaminated(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY,
                 id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id") -> DataFrame:
    """(id, item_id, similarity, start_word, r1, r2): one row per document and benchmark item found in it.

    Each is the item's best window, the first of equal ones. ``r1`` and ``r2`` hash the document's id and text.
    Null texts count as empty; items without words are found nowhere; items that repeat are reported under each id; a
    repeated document repeats its rows; either table may be empty. An item of fewer than five words is found wherever
    its words stand one after the other. Only the columns of id and text are read, whatever others are called.

    Documents are read where they lie. The items' distinct texts are sent to the tasks, in as many turns as keep each
    within ITEMS texts and ITEM_CHARACTERS characters on average; a turn of several is written down before the next is
    fetched. What is found is then joined with the items' ids.
    """
    kind = documents.schema[id_column].dataType.simpleString()
    t1, t2 = text_hash("words")
    items = benchmark.select(F.col(item_column).alias("item_id"), F.col("text").alias("words")) \
        .where("words is not null").withColumns({"t1": t1, "t2": t2})
    texts = pinned(items.groupBy("t1", "t2").agg(F.first("words").alias("words")))
    count, characters = texts.agg(F.count("*"), F.coalesce(F.sum(F.length("words")), F.lit(0))).first()
    turns = max(1, -(-count // ITEMS), -(-characters // ITEM_CHARACTERS))
    r1, r2 = text_hash(id_column, text_column)
    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), r1.alias("r1"), r2.alias("r2"))
    found = None
    for turn in range(turns):
        part = [((row.t1, row.t2), row.words) for row in texts.where(F.pmod("t2", F.lit(turns)) == turn).collect()]

        def scan(known: Benchmark, ids: list, texts: list, *hashes: list) -> Iterator[tuple]:
            for key, text, *row in zip(ids, texts, *hashes):
                for number, (similar, start) in sorted(known.found_in(text).items()):
                    yield key, *known.keys[number], similar, start, *row

        each = map_rows(rows, f"id {kind}, t1 long, t2 long, similarity double, start_word long, r1 long, r2 long",
                        scan, setup=lambda part=part: Benchmark(part, similarity))
        if turns > 1:
            each = pinned(each)
        found = each if found is None else found.unionAll(each)
    return found.join(items.select("t1", "t2", "item_id"), ["t1", "t2"]) \
        .select("id", "item_id", "similarity", "start_word", "r1", "r2")
