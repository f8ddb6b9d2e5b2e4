import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stallbook.llm import bpe, queries
from stallbook.llm.chunked import Pieces

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def encoded(text, size):
    """Pieces joined as a tree, without Spark."""
    pieces, model = Pieces(PATH, lead=False), bpe.word_model(PATH)
    nodes = [(bpe.encode_piece(pieces, model, piece, opened), opened) for piece, opened in bpe.pieces_of(text, size)]
    while len(nodes) > 1:
        pairs = [nodes[k:k + 2] for k in range(0, len(nodes), 2)]
        nodes = [(bpe.joined(model, pair[0][0], pair[1][0], pair[0][1]), pair[1][1]) if len(pair) == 2 else pair[0]
                 for pair in pairs]
    return nodes[0][0].tolist()


@pytest.mark.parametrize("seed", range(40))
def test_tree_equals_whole(library, seed):
    chance = random.Random(seed)
    words = ["internationalisation", "aaaaaaaa", "the", "ing", "ñandú", "漢字", "zzz", "antidisestablishment", "qu", "x"]
    glue = chance.choice(["", "", "", " ", "7", "!?", "'s", "\n"])
    text = glue.join(chance.choice(words) for _ in range(400))
    assert encoded(text, chance.choice([64, 100, 500])) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a" * 3000, "ab" * 1500, "!" * 2000, "-=" * 900, "1" * 900, "漢" * 700, "é" * 900,
                                  "x" * 300 + "'s" + "y" * 300, "<|endoftext|>" * 60, "İ" * 500, "é" * 300])
def test_unsplit_runs(library, text):
    assert encoded(text, 64) == library.encode(text, add_special_tokens=False).ids


def test_letters_join_without_the_cut_showing(library):
    letters = "".join(random.Random(5).choice("etaoinshrdlu") for _ in range(20_000))
    assert len(bpe.pieces_of(letters, 500)) > 30
    assert encoded(letters, 500) == library.encode(letters, add_special_tokens=False).ids


@pytest.mark.parametrize("size", [bpe.PIECE, 64])
def test_rows(spark, library, odd_documents, size):
    found = bpe.decode(bpe.encode(odd_documents, PATH, size=size), PATH).collect()
    expected = []
    for row in odd_documents.collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        expected.append((row.doc_id, ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted([tuple(row) for row in found], key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("size", [bpe.PIECE, 64])
def test_both_in_one_pass(odd_documents, size):
    """The rows of one operator over those of the other, and long texts are decoded whole."""
    once = bpe.encode_and_decode(odd_documents, PATH, size=size)
    after = bpe.decode(bpe.encode(odd_documents, PATH, size=size), PATH)
    assert once.columns == after.columns and once.dtypes == after.dtypes
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(map(tuple, after.collect()), key=repr)


def most_workers_of_a_task(df):
    """The most Python operators that stand in one stage of the plan, one fed from the other."""
    path, most = [], 0
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        name = line.lstrip(" :+-*(0123456789)")
        depth = len(line) - len(line.lstrip(" :+-"))
        path = [(d, n) for d, n in path if d < depth]
        above = path[-1][1] if path else 0
        n = 0 if "Exchange" in name.split(" ")[0] else above + any(kind in name.split(" ")[0] for kind in ("InArrow", "InPandas", "EvalPython"))
        path.append((depth, n))
        most = max(most, n)
    return most


def test_a_task_keeps_one_worker(odd_documents):
    """Two for each core stay alive beside the heap otherwise, each with caches and a tokenizer of its own."""
    assert most_workers_of_a_task(bpe.decode(bpe.encode(odd_documents, PATH, size=64), PATH)) == 2
    assert most_workers_of_a_task(bpe.encode_and_decode(odd_documents, PATH, size=64)) == 1
    assert most_workers_of_a_task(queries.bpe_digests(odd_documents)) == 1


def test_empty_table(no_documents):
    assert bpe.decode(bpe.encode(no_documents, PATH), PATH).collect() == []
    assert bpe.encode_and_decode(no_documents, PATH).collect() == []


def test_a_full_cache_starts_again(library, monkeypatch):
    from stallbook.llm import chunked

    monkeypatch.setattr(chunked, "CACHED_PIECES", 5)
    pieces = Pieces(PATH, lead=False)
    for text in ("a b c", "d e f a", "one two three four five six seven", "a b", "a b c d e", "f", "a b c"):
        assert pieces.encode(text) == b"".join(i.to_bytes(4, "little") for i in library.encode(text, add_special_tokens=False).ids)


def test_query(spark, table, library):
    found = {row.doc_id: row for row in queries.queries()["op3_bpe"](spark, "/root/testdata/sf0.001").collect()}
    for row in table("documents").collect():
        ids = library.encode(row.text, add_special_tokens=False).ids
        assert found[row.doc_id].n_tokens == len(ids)
        assert found[row.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert found[row.doc_id].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
