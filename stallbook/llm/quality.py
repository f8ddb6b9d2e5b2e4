"""Importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k (DSIR, 2023).

A document is the set of its features: five-letter n-grams inside words, and signs with how often they occur at
least, each hashed to a bucket. Both models say how likely a document is to have a bucket; the log-ratio of the two,
summed over a document's buckets, is its log importance weight. Only buckets count whose lack of good documents is more than
chance among the labelled ones, so a bucket's say depends on its evidence and not on how many documents there are. Adding
Gumbel noise and keeping the k best draws k documents without replacement, with the weights as probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.llm.common import slices
from stallbook.sources.shared import pinned

BUCKET_BITS = 18
TARGET_ROWS = 100_000     # labelled good documents that the target model is fitted on at most, and as many others
PRIOR = 0.5               # documents that both models are taken to have seen alike in each bucket
EVIDENCE = 2.5            # standard errors that a bucket's good documents must fall short by
MARGIN = 1.0              # log-ratios above -MARGIN say nothing against a document
GRAM = 5
PART = 1 << 20            # bytes of a text whose n-grams are formed at once
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SIGNS = np.frombuffer(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", np.uint8)
_APART = np.zeros(256, bool)
_APART[_SIGNS] = _APART[[9, 10, 11, 12, 13, 32]] = True


class Features:
    """Buckets of texts. Words end at ASCII white space and signs; a word's ends count as letters of its n-grams."""

    def __init__(self) -> None:
        self.seen = np.zeros(1 << BUCKET_BITS, bool)

    def buckets(self, text: str | None) -> np.ndarray:
        """Sorted distinct buckets of a text; none for an empty one."""
        lowered = (text or "").encode().lower()
        words = lowered.split()
        if not words:
            return np.zeros(0, np.int64)
        for first in range(0, len(lowered), PART):
            self._letters(np.frombuffer(b" " + lowered[first:first + PART + GRAM] + b" ", np.uint8))
        counts = np.bincount(np.frombuffer(lowered, np.uint8), minlength=256)[_SIGNS]
        # A word that repeats the one before it counts as a sign too.
        counts = np.r_[counts, sum(map(eq, words, words[1:]))]
        steps = np.where(counts > 0, np.frexp(counts)[1], 0)     # at least 1, 2, 4, ... times
        kinds = np.repeat(np.arange(len(counts)), steps)
        least = np.arange(len(kinds)) - np.repeat(np.cumsum(steps) - steps, steps)
        self._add((kinds * 64 + least + 1).astype(np.uint64) << np.uint64(40))
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        return found

    def _letters(self, raw: np.ndarray) -> None:
        apart = _APART[raw]
        letters = np.where(apart, np.uint8(32), raw).astype(np.uint64)
        n = len(raw) - GRAM + 1
        if n < 1:
            return
        grams = letters[:n]
        inside = np.ones(n, bool)
        for k in range(1, GRAM):
            grams = grams << np.uint64(8) | letters[k:k + n]
            if k < GRAM - 1:
                inside &= ~apart[k:k + n]
        self._add(grams[inside])

    def _add(self, features: np.ndarray) -> None:
        self.seen[(features * _GOLDEN) >> np.uint64(64 - BUCKET_BITS)] = True


def _label(labels: DataFrame, id_column: str) -> DataFrame:
    """One row per labelled id: good if every label of it says good quality and not toxic. Null labels say bad."""
    good = (F.coalesce("quality", F.lit(0)) == 1) & (F.coalesce("toxic", F.lit(1)) == 0)
    return labels.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("id")).agg(
        F.min(good).alias("good"))


class Model:
    """Log-ratios by bucket, and the share of the documents to keep."""

    def __init__(self, ratios: np.ndarray, share: float) -> None:
        self.ratios, self.share = ratios, share

    def log_weight(self, text: Column | str) -> Column:
        """A document's log importance weight, zero at most: null and empty texts have no feature and weigh zero."""
        ratios = self.ratios

        def weigh(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            features = Features()
            for texts in batches:
                yield pa.array([float(ratios[features.buckets(text)].sum())
                                for part in slices(texts) for text in part.to_pylist()], pa.float64())

        return F.arrow_udf("double")(_typed(weigh))(text)


def _typed(function):
    function.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return function


def _shortfall(of: np.ndarray, good: np.ndarray, share: float) -> np.ndarray:
    """Standard errors (the signed root of the deviance) that ``good`` falls short of ``share`` of ``of``; else zero."""
    def part(count: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(count > 0, count * np.log(np.maximum(count, 1) / np.maximum(expected, 1e-300)), 0.0)

    deviance = 2 * (part(good, of * share) + part(of - good, of * (1 - share)))
    return np.where(good < of * share, np.sqrt(np.maximum(deviance, 0.0)), 0.0)


def _ratios(raw: np.ndarray, good: np.ndarray, bad: np.ndarray, rows: list[int]) -> np.ndarray:
    """Log-ratios by bucket from the documents that have it, in all, good and bad; ``rows`` are the same of all buckets.

    The labelled tell whether a shortfall is chance; where they are all good, all documents do.
    """
    expected = raw * (rows[1] / max(1, rows[0]))
    of, all_rows = (good + bad, rows[1] + rows[2]) if rows[2] else (raw, rows[0])
    ratios = np.log((good + PRIOR) / (expected + PRIOR))
    sure = _shortfall(of, good, rows[1] / max(1, all_rows)) > EVIDENCE
    return np.where(sure & (ratios < -MARGIN), ratios, 0.0)


def fit(documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        target_rows: int = TARGET_ROWS) -> Model:
    """The raw model from all ``documents``, the target model from those that ``labels`` call good.

    One pass over the texts: each task adds up its documents by bucket, and the buckets are summed up. At most
    ``target_rows`` good ids, chosen by hash, mark the target's documents, and as many others the documents that it
    is tested against. Without any label all documents are kept.
    """
    known = pinned(_label(labels, id_column))
    share = known.agg(F.avg(F.col("good").cast("double"))).first()[0]
    if share is None:
        return Model(np.zeros(1 << BUCKET_BITS), 1.0)
    target, others = (known.where(F.col("good") == side).orderBy(F.xxhash64("id"), "id").limit(target_rows)
                      for side in (True, False))
    marked = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")) \
        .join(F.broadcast(target.unionAll(others)), "id", "left").select("text", "good")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, rows = Features(), [0, 0, 0]
        raw, good, bad = (np.zeros(1 << BUCKET_BITS, np.int64) for _ in range(3))
        for batch in (part for whole in batches for part in slices(whole)):
            for text, is_good in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                buckets = features.buckets(text)
                raw[buckets] += 1
                rows[0] += 1
                if is_good is not None:
                    (good if is_good else bad)[buckets] += 1
                    rows[1 if is_good else 2] += 1
        seen = np.flatnonzero(raw)
        # The number of documents goes along under a bucket of its own.
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[seen, -1]), *(pa.array(np.r_[counts[seen], n]) for counts, n in zip((raw, good, bad), rows))],
            ["bucket", "raw", "good", "bad"])

    sums = marked.mapInArrow(counted, "bucket long, raw long, good long, bad long").groupBy("bucket").agg(
        *(F.sum(kind).alias(kind) for kind in ("raw", "good", "bad"))).toPandas()   # a row per bucket at most
    real = sums.bucket >= 0
    counts = [np.zeros(1 << BUCKET_BITS) for _ in range(3)]
    for kind, of_kind in zip(("raw", "good", "bad"), counts):
        of_kind[sums.bucket[real]] = sums[kind][real]
    rows = [int(sums[kind][~real].sum()) for kind in ("raw", "good", "bad")]
    return Model(_ratios(*counts, rows), float(share))


def _gumbel(*columns: str | Column) -> Column:
    """Gumbel noise that a row always gets alike."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(971), *columns), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(uniform))


def _kth_largest(scores: DataFrame, k: int, few: int = 10_000) -> float | None:
    """The k-th largest of a column ``score`` without nulls; None if there are fewer rows.

    Counts by bucket narrow the range, a thousandfold each time, until few rows are left to sort.
    """
    low, high, total = scores.agg(F.min("score"), F.max("score"), F.count("*")).first()
    if total < k or k < 1:
        return None
    inside = scores
    while total > few and low < high:
        width = (high - low) / 1000
        place = F.least(F.floor((F.col("score") - low) / width), F.lit(999))
        counts = inside.groupBy(place.alias("place")).agg(
            F.count("*").alias("n"), F.min("score").alias("low"), F.max("score").alias("high")).collect()
        for row in sorted(counts, key=lambda row: -row.place):
            if k <= row.n:
                low, high, total = row.low, row.high, row.n
                break
            k -= row.n
        inside = scores.where(F.col("score").between(low, high))
    if low == high:
        return low
    return sorted((row.score for row in inside.select("score").collect()), reverse=True)[k - 1]


def resample(documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
             keep: float | None = None) -> DataFrame:
    """The documents kept, with all their columns and ``log_weight`` and ``sample_score``.

    k is the share ``keep`` of all documents, by default the share of good ones among the labelled. A row's noise
    comes from its id and text, so equal rows stay or go together, also at the k-th place. Null texts count as
    empty and weigh as much as a document without a fault; an empty table gives an empty result. The texts are read
    again for the last step rather than shuffled.
    """
    model = fit(documents, labels, id_column, text_column)
    noise = _gumbel(F.col(id_column), F.col(text_column))
    scores = pinned(documents.select((model.log_weight(text_column) + noise).alias("score")))
    k = round(scores.count() * (model.share if keep is None else keep))
    least = _kth_largest(scores, k)
    scored = documents.withColumn("log_weight", model.log_weight(text_column))
    scored = scored.withColumn("sample_score", F.col("log_weight") + noise)
    return scored.where(F.lit(False) if least is None else F.col("sample_score") >= least)
