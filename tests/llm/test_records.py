import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stallbook.llm import queries, records

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_checksum(data):
    state = 0xFFFFFFFF
    for byte in data:
        state ^= byte
        for _ in range(8):
            state = (state >> 1) ^ (0x82F63B78 if state & 1 else 0)
    state ^= 0xFFFFFFFF
    return (((state >> 15) | (state << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def test_checksums_bit_by_bit():
    generator = np.random.default_rng(1)
    messages = [generator.bytes(n) for n in (4, 5, 8, 127, 128, 129, 256, 1000)] + [bytes(8)]
    assert records.masked_checksums(messages) == [plain_checksum(m) for m in messages]
    # The published check value of CRC-32C, before masking.
    assert plain_checksum(b"123456789") == (((0xE3069283 >> 15) | (0xE3069283 << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def test_damage_is_found():
    record, = records.frame([b"some message"])
    assert records.unframe([record], "") == [b"some message"]
    with pytest.raises(ValueError):
        records.unframe([record[:14] + b"x" + record[15:]], "")


def test_a_token_id_too_large_is_an_error():
    ids = np.array([1, 65_535], "<u4")
    assert records.parsed(records.serialized(7, ids.tobytes(), 2))[1].tolist() == ids.tolist()
    with pytest.raises(ValueError, match="65536 does not fit"):
        records.serialized(7, (ids + 1).tobytes(), 2)


def test_folders_stand_where_spark_looks_for_them(spark, tmp_path):
    qualified = records._qualified(spark, str(tmp_path))
    assert qualified == f"file:{tmp_path}"
    assert records._place(qualified)[1] == records._place(str(tmp_path))[1] == str(tmp_path)
    with pytest.raises(ValueError, match="can't be written"):
        records._qualified(spark, "har:///archive.har/records")


def written(spark, documents, **options):
    folder = records.records_folder(spark)
    manifest = records.write_records(documents, folder, PATH, 2, **options)
    return folder, manifest, records.read_records(spark, manifest, folder).collect()


def expected(documents):
    library = Tokenizer.from_file(PATH)
    return [(row.doc_id, library.encode(row.text or "", add_special_tokens=False).ids + [2])
            for row in documents.select("doc_id", "text").collect()]


def ids(row):
    return np.frombuffer(row.ids, "<u4").tolist()


@pytest.mark.parametrize("files", [None, 3, 7])
def test_odd_rows_come_back_in_order(spark, odd_documents, files):
    _, manifest, rows = written(spark, odd_documents, files=files)
    rows.sort(key=lambda row: row.start)
    assert sorted(((row.key, ids(row)) for row in rows), key=repr) == sorted(expected(odd_documents), key=repr)
    keys = [row.key if row.key is not None else -1 for row in rows]
    assert keys == sorted(keys)
    position = 0
    for row in rows:
        assert row.start == position
        position += len(ids(row))


def test_empty_table(spark, no_documents):
    assert written(spark, no_documents)[2] == []


def test_index_serves_any_order(spark, odd_documents):
    folder, manifest, rows = written(spark, odd_documents, files=1)
    everything = list(records.read_range(folder, "part-000000"))
    order = np.random.default_rng(2).permutation(len(everything))
    for (key, found), place in zip(records.read_range(folder, "part-000000", order), order):
        assert key == everything[place][0] and found.tolist() == everything[place][1].tolist()


def test_an_id_that_fills_files_is_spread(spark):
    documents = spark.range(400).selectExpr("if(id % 3 = 0, 7, id) as doc_id", "concat('text ', id) as text")
    _, manifest, rows = written(spark, documents, files=8)
    assert max(row.records for row in manifest.collect()) < 110
    assert len(rows) == 400


def test_query(spark, table):
    found = {row.doc_id: row for row in queries.queries()["op1_records"](spark, "/root/testdata/sf0.001").collect()}
    position = 0
    for key, tokens in sorted(expected(table("documents"))):
        row = found.pop(key)
        assert (row.start, row.n_tokens) == (position, len(tokens))
        assert row.ids_crc32 == zlib.crc32(np.array(tokens, "<u4").tobytes())
        position += len(tokens)
    assert not found


def test_repeated_pieces_are_looked_up_once_in_a_group():
    """What Python does for a group of texts grows with its distinct pieces, not with all of them."""
    from public_tokenizers import path
    from stallbook.llm.chunked import Pieces, tokenizer

    class Counted(dict):
        looked_up = 0

        def __getitem__(self, piece):
            Counted.looked_up += 1
            return super().__getitem__(piece)

        def get(self, piece, default=None):
            Counted.looked_up += 1
            return super().get(piece, default)

    text = "head" + " one two, three" * 2000 + "  odd\n end"
    for name, lead in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        pieces = Pieces(path(name), lead)
        pieces.known, Counted.looked_up = Counted(), 0
        texts = [text, "", " ", text[:-12], "日本 語 one", "\n one", "one"]
        found = [np.frombuffer(ids, "<u4").tolist() for ids in pieces.encode_all(texts)]
        assert found == [tokenizer(path(name)).encode(x, add_special_tokens=False).ids for x in texts]
        assert Counted.looked_up < 50
