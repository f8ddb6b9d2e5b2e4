"""Landing raw CSV files as untyped text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook import schemas
from stallbook.sources.shared import pinned
from stallbook.sources.tables import Tables

# A value that cannot occur in UTF-8 text files: with it as the NULL marker an
# empty unquoted field becomes NULL and a quoted "" stays an empty string.
_OPTIONS = {"escape": '"', "nullValue": "\u0001", "emptyValue": "", "mode": "FAILFAST"}

CHUNK = 1 << 20     # characters that a chunk of lines holds, but for the line that goes over

# Only free text holds line breaks; the other tables have one line per record.
TABLES_WITH_LINE_BREAKS = frozenset({"order_reviews"})


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, line_breaks: bool = False,
             chunk: int = CHUNK) -> DataFrame:
    """A CSV with a header, as declared columns.

    The header is skipped unread, and with it a byte order mark. Quotes inside
    a quoted field are doubled; CRLF line ends are accepted. With
    ``line_breaks`` a quoted field may span lines, an empty line is a NULL in
    a file of one column and refused in any other, and a quote left open is an
    error that names the file. Without it, Spark's reader skips empty lines.
    """
    if not line_breaks:
        return spark.read.schema(schema).options(header=True, encoding="UTF-8", **_OPTIONS).csv(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    row = F.from_csv("record", F.lit(columns), _OPTIONS)
    if len(schema) == 1:   # an empty line is an empty field, which the parser would refuse
        row = F.when(F.col("record") == "", F.struct(F.lit(None).cast(schema[0].dataType).alias(schema[0].name))).otherwise(row)
    return _records(spark, path, chunk).select(row.alias("row")).select("row.*")


def _starts(lines: list[str]) -> tuple[list[int], int]:
    """The parity of the quotes before each line, and of all together."""
    parities, parity = [], 0
    for line in lines:
        parities.append(parity)
        parity ^= line.count('"') & 1
    return parities, parity


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Lines of a block put together to chunks, with what each would begin and leave open if a quote were open at its
    beginning or not."""
    names = ["file", "block", "chunk", "text", "quotes", "starts_closed", "starts_open", "head", "tail_closed", "tail_open"]

    def packed(file: str, block: int, chunk: int, lines: list[str]) -> pa.RecordBatch:
        parities, last = _starts(lines)
        found = []
        for opened in (0, 1):
            begun = [i for i, parity in enumerate(parities) if parity == opened]
            tail = "\n".join(lines[begun[-1]:]) if begun and last != opened else None
            found.append((len(begun), "\n".join(lines[:begun[0]] if begun else lines), tail))
        (closed, _, tail_closed), (opened, head, tail_open) = found
        row = [file, block, chunk, "\n".join(lines), last, closed, opened, head, tail_closed, tail_open]
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()] + [pa.string()] * 3
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names)

    at, chunk, lines, size = None, 0, [], 0
    for batch in batches:
        for file, block, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if at != (file, block) or size >= most:
                if lines:
                    yield packed(*at, chunk, lines)
                chunk = chunk + 1 if at == (file, block) else 0
                at, lines, size = (file, block), [], 0
            lines.append(value)
            size += len(value) + 1
    if lines:
        yield packed(*at, chunk, lines)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records that begin and end in a chunk, but for the file's first, which is its header."""
    for batch in batches:
        for text, opened, records in zip(*(batch.column(i).to_pylist() for i in range(3))):
            lines = text.split("\n")
            parities, last = _starts(lines)
            begun = [i for i, parity in enumerate(parities) if parity == opened]
            ends = [*begun[1:], len(lines)]
            found = ["\n".join(lines[i:j]) for i, j in zip(begun, ends)]
            if begun and last != opened:
                found.pop()
            if found and records == 0:
                found = found[1:]
            for start in range(0, len(found), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(found[start:start + 4096], pa.string())], ["record"])


def _records(spark: SparkSession, path: str | list[str], chunk: int) -> DataFrame:
    """The records of CSV files in which quoted fields span lines, as text. The files are read once.

    Spark's own reader takes such a file in one task. Here the lines are read in parallel and written down in chunks
    of a block. Whether a quote is open where a chunk begins is the parity of the quotes before it in the file, a
    running sum over one narrow row per chunk. With that each chunk gives its whole records where it lies; only the
    pieces of records that go over a chunk's end, kept beside it, travel to be put together.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    chunks = pinned(lines.mapInArrow(
        lambda batches: _chunks(batches, chunk),
        "file string, block long, chunk long, text string, quotes long, starts_closed long, starts_open long, "
        "head string, tail_closed string, tail_open string"))
    earlier = Window.partitionBy("file").orderBy("block", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    # A quote left open would gather the rest of the file in one record.
    in_file = F.sum("quotes").over(Window.partitionBy("file"))
    left_open = F.raise_error(F.concat(F.lit("a quote is left open in "), "file"))
    index = (chunks.select("file", "block", "chunk", "quotes", "starts_closed", "starts_open")
             .withColumn("opened", F.when(in_file % 2 == 1, left_open)
                         .otherwise(F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2))
             .withColumn("starts", F.when(F.col("opened") == 0, F.col("starts_closed")).otherwise(F.col("starts_open")))
             .withColumn("records", F.coalesce(F.sum("starts").over(earlier), F.lit(0))))
    index = pinned(index.select("file", "block", "chunk", "opened", "starts", "records"))
    place = ["file", "block", "chunk"]
    whole = chunks.select(*place, "text").join(index, place).select("text", "opened", "records").mapInArrow(
        _whole, "record string")

    # A piece belongs to the record that was the last to begin before it, or with it.
    tail = F.when(F.col("opened") == 0, F.col("tail_closed")).otherwise(F.col("tail_open"))
    pieces = chunks.select(*place, "head", "tail_closed", "tail_open").join(index, place).select(*place, F.explode(F.array(
        F.struct(F.when(F.col("opened") == 1, F.col("head")).alias("value"), F.col("records").alias("number")),
        F.struct(tail.alias("value"), (F.col("records") + F.col("starts")).alias("number")))).alias("piece"))
    parts = F.array_sort(F.collect_list(F.struct("block", "chunk", F.col("piece.value").alias("value"))))
    joined = (pieces.where("piece.value IS NOT NULL AND piece.number > 1").groupBy("file", "piece.number")
              .agg(F.array_join(F.transform(parts, lambda part: part["value"]), "\n").alias("record")))
    return whole.unionByName(joined.select("record")).select(F.regexp_replace("record", "\r$", "").alias("record"))


def land(spark: SparkSession, folder: str, pattern: str = "{table}.csv",
         files: dict[str, str] | None = None) -> Tables:
    """The nine raw tables under ``folder``, every column text.

    ``pattern`` names the files after their tables; ``files`` overrides single
    names. Both may hold globs, so a table can be many files.
    """
    files = files or {}

    def maker(table: str) -> Callable[[], DataFrame]:
        path = f"{folder}/{files.get(table, pattern.format(table=table))}"
        return lambda: read_csv(spark, path, schemas.landing_schema(table),
                                line_breaks=table in TABLES_WITH_LINE_BREAKS)

    return Tables({table: maker(table) for table in schemas.LANDING_COLUMNS})


def write_csv(df: DataFrame, path: str) -> None:
    """Write ``df`` in the form ``read_csv`` reads: header, doubled quotes, NULL
    as an empty field and the empty string as a quoted one."""
    (df.write.option("header", True).option("escape", '"').option("nullValue", "")
     .option("emptyValue", '""').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
