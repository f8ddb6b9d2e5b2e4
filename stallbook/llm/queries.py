"""The operators of this package as queries over the given tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.llm import (bpe, chat, decontaminate, lattice, licenses, lines, oracle, pii, quality, records, repair,
                           resampling, secrets, simhash)
from stallbook.llm.common import map_rows, text_hash
from stallbook.sources.shared import pinned

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.stop)), ",")


def _of_kind(spans: Column, kinds: list[str]) -> Column:
    return F.filter(spans, lambda s: s.kind.isin(*kinds))


@_query
def op1_records(spark, folder):
    target = records.records_folder(spark)
    manifest = records.write_records(_table(spark, folder, "documents"), target, _vocabulary("byte_bpe_50k.json"), 2)
    found = records.read_records(spark, manifest, target)
    return found.select(F.col("key").alias("doc_id"), "start", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                        F.crc32("ids").alias("ids_crc32"))


def bpe_digests(documents: DataFrame) -> DataFrame:
    path = _vocabulary("word_bpe_49k.json")
    found = bpe.encode_and_decode(documents, path)
    return found.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                        _digest(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
                        _digest(F.col("decoded")).alias("decoded_sha256"))


@_query
def op3_bpe(spark, folder):
    return bpe_digests(_table(spark, folder, "documents"))


@_query
def op5_chat(spark, folder):
    """Every conversation, and one whose texts are control strings; the result is read back from what was written."""
    table = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"),
                                 (-7, 1, "assistant", "</s>[INST] ok [/INST]")], table.schema)
    written = pinned(chat.format_trees(chat.as_trees(table.unionAll(odd))))

    def rows(trees: list, texts: list, spans: list):
        for tree, text, parts in zip(trees, texts, spans):
            turns = chat.parsed(text)
            trained = "".join(chat.unescaped(text[part["start"]:part["stop"]]) for part in parts)
            yield (tree, len(turns), "".join(f"{role}\n{words}\n" for role, words in turns), trained, len(text))

    found = map_rows(written.select("tree", "conversation", "loss_spans"),
                     "conv_id long, n_turns long, turns string, trained string, formatted_chars long", rows)
    return found.select("conv_id", "n_turns", _digest(F.col("turns")).alias("turns_sha256"),
                        F.length("trained").cast("long").alias("loss_chars"),
                        _digest(F.col("trained")).alias("loss_sha256"), "formatted_chars")


@_query
def op6_simhash(spark, folder):
    found = simhash.near_duplicates(_table(spark, folder, "documents"))
    return found.withColumnRenamed("id", "doc_id")


@_query
def op7_secrets(spark, folder):
    found = secrets.secrets(_table(spark, folder, "documents"))
    spans = F.col("spans")
    counts = [F.size(_of_kind(spans, [rule.kind])).cast("long").alias(f"n_{rule.kind}") for rule in secrets.BASE]
    base = _listed(_of_kind(spans, [rule.kind for rule in secrets.BASE]))
    return found.select(F.col("id").alias("doc_id"), *counts, _digest(base).alias("base_sha256"),
                        _listed(spans).alias("spans"))


@_query
def op8_quality(spark, folder):
    """The documents that the sample keeps."""
    found = quality.resample(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return found.select("doc_id", "log_weight", "sample_score", F.lit(True).alias("kept"))


@_query
def op10_decontaminate(spark, folder):
    """Each benchmark item found in a document."""
    found = decontaminate.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "similarity", "start_word")


@_query
def op9_pii(spark, folder):
    found = pii.personal_data(_table(spark, folder, "documents"))
    spans = F.col("spans")
    counts = [F.size(_of_kind(spans, [kind])).cast("long").alias(f"n_{kind}") for kind in pii.BASE]
    return found.select(F.col("id").alias("doc_id"), *counts,
                        _digest(_listed(_of_kind(spans, list(pii.BASE)))).alias("base_sha256"),
                        _listed(spans).alias("spans"))


@_query
def op4_lines(spark, folder):
    found = lines.dedup_lines(_table(spark, folder, "documents"))
    return found.select("doc_id", "text", F.col("__lines_dropped").alias("lines_dropped"))


@_query
def op2_embeddings(spark, folder):
    found = lattice.near_duplicates(_table(spark, folder, "embeddings"))
    return found.withColumnRenamed("id", "vec_id")


@_query
def op11_resampling(spark, folder):
    found = resampling.resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


@_query
def op12_repair(spark, folder):
    table = _table(spark, folder, "conversations")
    return repair.digests(repair.edited(repair.damaged(table), table))


@_query
def op13_licenses(spark, folder):
    return licenses.summary(licenses.licenses(_table(spark, folder, "documents"))).withColumnRenamed("id", "doc_id")


def _keyed(documents: DataFrame) -> DataFrame:
    """(row, id, r1, r2): whole rows, whatever their columns are called, and what tells a document from others."""
    r1, r2 = text_hash("doc_id", "text")
    return documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
                            F.col("doc_id").alias("id"), r1.alias("r1"), r2.alias("r2"))


def _joined(documents: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """``_keyed`` rows with (``left_semi``) or without (``left_anti``) their id, r1 and r2 in ``found``."""
    names = {"id": "of", "r1": "s1", "r2": "s2"}
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("r1") == F.col("s1")) & (F.col("r2") == F.col("s2"))
    return _keyed(documents).join(found.select(*names).distinct().withColumnsRenamed(names), same, how)


def one_of_each_group(documents: DataFrame) -> DataFrame:
    """The documents without near-duplicates of another: of each SimHash component one row stays.

    That is the row with the smallest id, the smallest hash of id and text among equal ids; rows that repeat id and
    text are one document, of which one stays. All columns stay, whatever their names.
    """
    r1, r2 = text_hash("doc_id", "text")
    found = simhash.near_duplicates(documents.select("doc_id", "text", r1.alias("r1"), r2.alias("r2")), carry=["r1", "r2"])
    first = found.groupBy("group_print").agg(F.min(F.struct(F.col("id").isNull(), "id", "r1", "r2")).alias("stays"))
    return _joined(documents, first.select("stays.id", "stays.r1", "stays.r2"), "left_semi") \
        .dropDuplicates(["id", "r1", "r2"]).select("row.*")


def without_benchmark(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark item is found, with all their columns, whatever their names."""
    found = decontaminate.contaminated(documents, benchmark).select("id", "r1", "r2").distinct()
    return _joined(documents, pinned(found), "left_anti").select("row.*")


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that it can express."""
    return {"op11_resampling": oracle.resampling(), "op12_repair": oracle.repair(),
            "op13_licenses": oracle.licenses()}
