"""A training corpus from raw documents, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.llm import lines, quality, queries
from stallbook.sources.shared import pinned


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Importance resampling against ``labels``; what the sample leaves out goes."""
    found = quality.resample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select(docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated lines; ``n_chars`` follows, and no document goes."""
    found = lines.dedup_lines(docs)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.when(F.col("__lines_dropped") > 0, length).otherwise(F.col("n_chars")))
    return found.select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays."""
    return queries.one_of_each_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return queries.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left, as op3 returns them."""
    return queries.bpe_digests(docs)


STAGES = [("quality_classifier", keep_good), ("line_dedup", dedup_lines), ("simhash_near_dedup", near_dedup),
          ("benchmark_decontamination", decontaminate), ("bpe", encode)]

# The fingerprints, the classifier and the tokenizer are out of SQL's reach.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written down before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = pinned(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
