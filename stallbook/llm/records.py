"""Token ids as length-delimited binary records, with an offset index beside each file.

A record is framed as in TFRecord files: length (u64), masked CRC-32C of the length (u32), data, masked CRC-32C of
the data (u32), all little-endian. The data is one document: a null flag and the id (u8, i64), the width of a token
id in bytes (u8), then the ids. ``part-N.index`` holds a record's offset and length (two u64) per entry, so readers
can fetch records in any order.
"""

from __future__ import annotations

import posixpath
import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stallbook.llm.chunked import pieces_of_worker
from stallbook.sources.shared import new_folder, pinned

ROWS_PER_FILE = 4096      # documents aimed at per record file
LANE = 128                # bytes that the checksum takes side by side
_POLYNOMIAL = 0x82F63B78  # fixed value: CRC-32C, reflected
_MASK = 0xA282EAD8        # fixed value: the mask of TFRecord checksums


def _table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1)
    return table


_BYTE = _table()


def _after_zeros(count: int) -> list[list[int]]:
    """What a checksum state becomes after ``count`` zero bytes: one table per byte of the state."""
    states = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).ravel()
    for _ in range(count):
        states = _BYTE[states & 0xFF] ^ (states >> 8)
    return states.reshape(4, 256).tolist()


_LANE_ZEROS = _after_zeros(LANE)


def masked_checksums(messages: list[bytes]) -> list[int]:
    """Masked CRC-32C of each message (4 bytes or more).

    All messages are cut into lanes of equal length, which numpy steps through side by side; a message's lanes are
    then folded into one. Zeros put in front change nothing, as the start value is worked into the first bytes.
    """
    padded, counts = [], []
    for message in messages:
        lanes = -(-len(message) // LANE)
        start = bytes(255 - byte for byte in message[:4])
        padded += [bytes(lanes * LANE - len(message)), start, message[4:]]
        counts.append(lanes)
    lanes = np.frombuffer(b"".join(padded), np.uint8).reshape(-1, LANE)
    columns = np.ascontiguousarray(lanes.T)
    states = np.zeros(len(lanes), np.uint32)
    for column in columns:
        states = _BYTE[(states ^ column) & 0xFF] ^ (states >> 8)
    t0, t1, t2, t3 = _LANE_ZEROS
    values, position = states.tolist(), 0
    sums = []
    for count in counts:
        state = 0
        for value in values[position:position + count]:
            state = t0[state & 255] ^ t1[state >> 8 & 255] ^ t2[state >> 16 & 255] ^ t3[state >> 24] ^ value
        position += count
        state ^= 0xFFFFFFFF
        sums.append((((state >> 15) | (state << 17)) + _MASK) & 0xFFFFFFFF)
    return sums


def frame(messages: list[bytes]) -> list[bytes]:
    lengths = [struct.pack("<Q", len(message)) for message in messages]
    # A length is 8 bytes, so it is summed like any other message.
    sums = masked_checksums(lengths + messages)
    return [length + struct.pack("<I", first) + message + struct.pack("<I", second)
            for length, message, first, second in zip(lengths, messages, sums, sums[len(messages):])]


def unframe(records: list[bytes], where: str) -> list[bytes]:
    messages = [record[12:-4] for record in records]
    sums = masked_checksums([record[:8] for record in records] + messages)
    for record, message, first, second in zip(records, messages, sums, sums[len(records):]):
        if struct.unpack_from("<QI", record) != (len(message), first) or record[-4:] != struct.pack("<I", second):
            raise ValueError(f"{where}: a record is damaged")
    return messages


def serialized(key: int | None, ids: bytes, id_bytes: int) -> bytes:
    values = np.frombuffer(ids, "<u4")
    if len(values) and int(values.max()) >> 8 * id_bytes:
        raise ValueError(f"token id {values.max()} does not fit into {id_bytes} bytes")
    values = values.astype(f"<u{id_bytes}")
    return struct.pack("<BqB", key is None, key or 0, id_bytes) + values.tobytes()


def parsed(message: bytes) -> tuple[int | None, np.ndarray]:
    missing, key, id_bytes = struct.unpack_from("<BqB", message)
    return None if missing else key, np.frombuffer(message, f"<u{id_bytes}", offset=10)


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme: one without stands on Spark's default file system, not on a task's own disk.

    Tasks reach it by pyarrow, so a scheme that pyarrow doesn't know is an error here, before anything is encoded.
    """
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsparkSession.sessionState().newHadoopConf()
    path = hadoop.Path(folder)
    scheme = path.toUri().getScheme() or hadoop.FileSystem.getDefaultUri(conf).getScheme()
    known = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    if known not in ("file", "hdfs", "viewfs", "s3", "gs", "gcs", "abfs", "abfss"):
        raise ValueError(f"{folder}: record files can't be written to {scheme}: folders")
    whole = path.getFileSystem(conf).makeQualified(path).toString()
    return known + whole.removeprefix(scheme)


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system a task reaches a folder by, and its path there; one without a scheme is on this machine."""
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def _cuts(documents: DataFrame, id_column: str, files: int) -> list[int]:
    """Ids at which the files begin: quantiles of the id column alone, a few numbers whatever the table's size."""
    steps = [k / files for k in range(1, files)]
    found = documents.agg(F.percentile_approx(id_column, steps, 10 * files).alias("cuts")).first()
    return found.cuts or [] if found else []


def write_records(documents: DataFrame, folder: str, tokenizer_path: str, end_id: int | None, id_column: str = "doc_id",
                  text_column: str = "text", lead: bool = True, id_bytes: int = 2,
                  files: int | None = None) -> DataFrame:
    """Encode ``documents`` and write them in ascending id order; returns the manifest, one row per file.

    The manifest has file, part, records, tokens and the number of tokens before the file. Null text is encoded as
    empty, null ids come first, equal ids are ordered by their ids' bytes, a repeated row is a record of its own; an
    empty table gives an empty manifest. Ids need an integer column. A token id that ``id_bytes`` can't hold is an
    error.

    Rows are dealt to files by quantiles of the id, and an id that fills several files is spread over them by its
    content. Every file is written under a name of its own and then renamed, so a repeated task replaces a file
    with the same content.
    """
    folder = _qualified(documents.sparkSession, folder)
    files = files or max(1, -(-documents.count() // ROWS_PER_FILE))
    cuts = _cuts(documents, id_column, files) if files > 1 else []

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of_worker(tokenizer_path, lead)
        end = b"" if end_id is None else struct.pack("<I", end_id)
        for batch in batches:
            rows = [], [], []
            keys, texts = (column.to_pylist() for column in batch.columns)
            for key, ids in zip(keys, pieces.encode_all([text or "" for text in texts])):
                message = serialized(key, ids + end, id_bytes)
                # Among files that start with the same id, content decides.
                first, last = (0, 0) if key is None else (bisect_left(cuts, key), bisect_right(cuts, key))
                rows[0].append(first + zlib.crc32(message) % (last - first + 1))
                rows[1].append(key)
                rows[2].append(message)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.int64()),
                                              pa.array(rows[2], pa.binary())], ["part", "key", "message"])

    dealt = documents.select(F.col(id_column).cast("long"), text_column) \
        .mapInArrow(encoded, "part int, key long, message binary") \
        .repartitionById(files, F.col("part")).sortWithinPartitions("part", "key", "message")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _place(folder)
        out = index = None
        for batch in batches:
            if out is None:
                part = batch.column(0)[0].as_py()
                name, trial = f"part-{part:06d}", f"{path}/_trial-{uuid4().hex}"
                system.create_dir(path)
                out, index = system.open_output_stream(trial), []
                records = tokens = offset = 0
            messages = batch.column(2).to_pylist()
            for first in range(0, len(messages), 256):
                for record in frame(messages[first:first + 256]):
                    out.write(record)
                    index.append((offset, len(record)))
                    offset += len(record)
                    tokens += (len(record) - 26) // id_bytes
            records += len(messages)
        if out is not None:
            out.close()
            with system.open_output_stream(f"{trial}.index") as file:
                file.write(np.array(index, "<u8").tobytes())
            system.move(trial, f"{path}/{name}.records")
            system.move(f"{trial}.index", f"{path}/{name}.index")
            yield pa.RecordBatch.from_pydict({"file": [name], "part": pa.array([part], pa.int32()),
                                              "records": [records], "tokens": [tokens]})

    summary = pinned(dealt.mapInArrow(written, "file string, part int, records long, tokens long"))
    # One row per file: a running total over so few rows is one short task.
    before = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return pinned(summary.withColumn("before", F.coalesce(before, F.lit(0))))


def read_range(folder: str, file: str, entries: np.ndarray | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
    """(id, token ids) of a file's records: in order, or those at ``entries``, in their order, by the index."""
    system, path = _place(folder)
    with system.open_input_file(f"{path}/{file}.index") as source:
        index = np.frombuffer(source.read(), "<u8").reshape(-1, 2)
    wanted = index if entries is None else index[entries]
    with system.open_input_file(f"{path}/{file}.records") as source:
        for first in range(0, len(wanted), 256):
            records = [source.read_at(int(length), int(offset)) for offset, length in wanted[first:first + 256]]
            for message in unframe(records, f"{path}/{file}"):
                yield parsed(message)


def read_records(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """Every record of the files: key, position (tokens of all records before it) and ids, one task per file."""
    files, folder = max(1, manifest.count()), _qualified(spark, folder)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(keys: list, starts: list, ids: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(starts, pa.int64()),
                                               pa.array(ids, pa.binary())], ["key", "start", "ids"])

        for batch in batches:
            for file, position in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found: tuple[list, list, list] = [], [], []
                size = 0
                for key, ids in read_range(folder, file):
                    for column, value in zip(found, (key, position, ids.astype("<u4").tobytes())):
                        column.append(value)
                    position += len(ids)
                    size += len(ids)
                    if size > 1 << 21:
                        yield packed(*found)
                        found, size = ([], [], []), 0
                yield packed(*found)

    numbered = manifest.select("file", "before", "part").repartitionById(files, F.pmod("part", F.lit(files)))
    return numbered.select("file", "before").mapInArrow(rows, "key long, start long, ids binary")


def records_folder(spark: SparkSession) -> str:
    """A folder for record files that live as long as the session."""
    return new_folder(spark, "records")
