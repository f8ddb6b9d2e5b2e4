"""Importance resampling towards a target: hashed n-gram gains from overlapped regex scans, Gumbel top-k.

A text's bytes are folded (A-Z to lower case, every other ASCII character that is no letter or digit to a space) and
its runs of spaces collapsed, so that one regex finds an n-gram as a span of the text itself: ``finditer`` with
``overlapped=True`` starts again one byte further on, and lookarounds admit only whole words. A span's CRC-32 modulo
``buckets`` is its feature. Each text is scanned once; its buckets and counts are written down, and both the corpus
counts and the documents' weights come from there.

Results for odd rows: a null or empty text has no features, weight 0 and, below ``least_words``, no rank. A null id
hashes as the empty string and ranks after other ids. Repeated rows each get a result and a rank of their own. Without
documents the result is empty; without target texts every gain comes from the raw counts alone. Other columns are not
looked at, so their names cannot clash.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from operator import methodcaller
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.llm.common import map_rows
from stallbook.operators.ordered import split_running_sum
from stallbook.sources.shared import pinned

BUCKETS = 10_000
LEAST_WORDS = 20    # documents with fewer words are not drawn
PER_CENT = 10       # of the others, drawn
SEED = 2024

_SPACE = ord(" ")
_FOLDED = bytes(_SPACE if chr(c).isascii() and not chr(c).isalnum() else ord(chr(c).lower()) if c < 128 else c
                for c in range(256))


def folded(text: bytes) -> bytes:
    """Words in lower case with one space between them; UTF-8's other bytes all count as letters."""
    return re.sub(rb" {2,}", b" ", text.translate(_FOLDED)).strip(b" ")


def scanner(length: int) -> regex.Pattern:
    """Finds every run of ``length`` words of a folded text when it scans overlapped."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (length - 1))


def features(texts: DataFrame, id_column: str | None, text_column: str, shortest: int = 1, longest: int = 1,
             buckets: int = BUCKETS) -> DataFrame:
    """(id, n_words, n_features, places, counts) per row: the buckets of its n-grams and how often each comes."""
    if not 1 <= shortest <= longest:
        raise ValueError(f"n-grams of {shortest} to {longest} words")
    key = F.col(id_column) if id_column else F.lit(None).cast("long")
    type_ = texts.schema[id_column].dataType.simpleString() if id_column else "long"

    def scanned(patterns: list, ids: list, contents: list) -> Iterator[tuple]:
        for id_, content in zip(ids, contents):
            text = folded(content)
            found: Counter = Counter()
            for pattern in patterns:
                found.update(map(methodcaller("group"), pattern.finditer(text, overlapped=True)))
            places = np.fromiter(map(crc32, found), np.int64, len(found)) % buckets
            counts = np.fromiter(found.values(), np.int64, len(found))
            yield id_, text.count(b" ") + 1 if text else 0, found.total(), places.astype(np.int32), counts

    rows = texts.select(key.alias("id"), F.coalesce(F.col(text_column).cast("binary"), F.lit(b"")).alias("content"))
    return map_rows(rows, f"id {type_}, n_words long, n_features long, places array<int>, counts array<long>", scanned,
                    rows=256, setup=lambda: [scanner(n) for n in range(shortest, longest + 1)])


def _flat(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False)


def bucket_counts(vectors: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features lie in each bucket. Every task adds its own up first; the driver gets one row per bucket."""
    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            np.add.at(total, _flat(batch.column("places")), _flat(batch.column("counts")))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["place", "n"])

    parts = vectors.select("places", "counts").mapInArrow(added, "place int, n long")
    total = np.zeros(buckets, np.int64)
    for row in parts.groupBy("place").agg(F.sum("n").alias("n")).collect():
        total[row["place"]] = row["n"]
    return total


def gains(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Per bucket, 1000 times the log of how much likelier the target model makes it, rounded down.

    Both models count every bucket once more than was seen.
    """
    t_all, s_all, buckets = float(target.sum()), float(raw.sum()), len(raw)
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
                     for t, s in zip(target.astype(float), raw.astype(float))], np.int64)


def weighed(vectors: DataFrame, gain: np.ndarray) -> DataFrame:
    """(id, n_words, n_features, weight): the sum of a document's gains."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            upto = np.concatenate([[0], np.cumsum(gain[_flat(batch.column("places"))] * _flat(batch.column("counts")))])
            ends = np.cumsum(pc.list_value_length(batch.column("places")).to_numpy(zero_copy_only=False))
            weight = upto[ends] - upto[np.concatenate([[0], ends[:-1]])] if len(ends) else ends
            columns = [batch.column(name) for name in ("id", "n_words", "n_features")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(weight.astype(np.int64))],
                                             ["id", "n_words", "n_features", "weight"])

    type_ = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(sums, f"id {type_}, n_words long, n_features long, weight long")


def _noise(seed: int):
    """Gumbel noise from the id's hash, in thousandths, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(documents: DataFrame, target: DataFrame, id_column: str = "doc_id", text_column: str = "text",
             target_column: str = "text", shortest: int = 1, longest: int = 1, buckets: int = BUCKETS,
             least_words: int = LEAST_WORDS, per_cent: int = PER_CENT, seed: int = SEED) -> DataFrame:
    """(id, n_features, weight, score, rank, n_words) for every document; rank is null for those not drawn.

    Drawn is that share of the documents with ``least_words`` words or more that scores highest. They are ranked by a
    range sort of narrow rows, so no task holds more than its range.
    """
    vectors = pinned(features(documents, id_column, text_column, shortest, longest, buckets))
    wanted = features(target, None, target_column, shortest, longest, buckets)
    gain = gains(bucket_counts(wanted, buckets), bucket_counts(vectors, buckets))
    # ``row`` tells repeated rows apart, so that any number of them can be cut into ranges.
    scored = pinned(weighed(vectors, gain).withColumn("score", F.col("weight") + _noise(seed))
                    .withColumn("row", F.monotonically_increasing_id()).withColumn("one", F.lit(1).cast("long")))
    long_enough = F.col("n_words") >= least_words
    drawn = scored.where(long_enough).count() * per_cent // 100
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features"), F.col("weight"), F.col("row")]
    ranked = split_running_sum(scored.where(long_enough), [], order, "one", "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    others = scored.where(~long_enough).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(others).select("id", "n_features", "weight", "score", "rank", "n_words")
