import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import duckdb
import pytest

from stallbook.llm import queries, resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def grams(text, shortest, longest):
    found = words(text)
    return [" ".join(found[k:k + n]) for n in range(shortest, longest + 1) for k in range(len(found) - n + 1)]


def plain(documents, target, shortest=1, longest=1, buckets=10_000, least=20, per_cent=10, seed=2024):
    """(id, n_features, weight, score, rank) by counting everything in one place."""
    def place(gram):
        return crc32(gram.encode()) % buckets

    raw = Counter(place(g) for _, text in documents for g in grams(text, shortest, longest))
    wanted = Counter(place(g) for text in target for g in grams(text, shortest, longest))
    S, T = raw.total(), wanted.total()
    rows = []
    for id_, text in documents:
        found = grams(text, shortest, longest)
        weight = sum(math.floor(1000 * math.log((wanted[b] + 1) * (S + buckets) / ((raw[b] + 1) * (T + buckets))))
                     for b in map(place, found))
        h = int(hashlib.sha256(f"{seed}:{'' if id_ is None else id_}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([id_, len(found), weight, score, len(words(text)) >= least])
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, row in enumerate(able):
        row[4] = k + 1 if k < per_cent * len(able) // 100 else None
    return [tuple(r[:4]) + (r[4] or None,) for r in rows]


def key(row):
    return tuple((x is None, x or 0) for x in row)


def same(found, expected):
    rows = [(r.id, r.n_features, r.weight, r.score, r.rank) for r in found.collect()]
    assert sorted(rows, key=key) == sorted(expected, key=key)


PARTS = ["a", "B", "word", "Zz", "9", "é", "漢字", "İ", " ", "\x00", "'", " ", "  ", "\n", "-", "x_y", "\x7f", "\xa0"]


@pytest.mark.parametrize("shortest, longest", [(1, 1), (2, 2), (1, 3)])
def test_same_as_counting_in_one_place(spark, shortest, longest):
    chance = random.Random(shortest)
    texts = ["".join(chance.choice(PARTS) + chance.choice(["", " "]) for _ in range(chance.randrange(80))) for _ in range(300)]
    documents, target = list(enumerate(texts)), ["a B word", "9 9 9 é", None, "漢字 word"]
    found = resampling.resample(spark.createDataFrame(documents, "doc_id long, text string"),
                                spark.createDataFrame([(t,) for t in target], "text string"),
                                shortest=shortest, longest=longest, buckets=97, least_words=5, per_cent=30, seed=7)
    same(found, plain(documents, target, shortest, longest, 97, 5, 30, 7))


def test_scanner_and_folding():
    assert resampling.folded("  Ab--cÉ 9.\n".encode()) == "ab cÉ 9".encode()
    assert [m.span() for m in resampling.scanner(2).finditer(b"a bc d", overlapped=True)] == [(0, 4), (2, 6)]
    assert not list(resampling.scanner(3).finditer(b"a b", overlapped=True))


def test_odd_rows(spark, odd_documents, no_documents, table):
    target = table("benchmark")
    expected = plain([(r.doc_id, r.text) for r in odd_documents.collect()], [r.text for r in target.collect()],
                     least=1, per_cent=50)
    same(resampling.resample(odd_documents, target, least_words=1, per_cent=50), expected)
    assert resampling.resample(no_documents, target).collect() == []
    nothing = target.where("false")
    same(resampling.resample(odd_documents, nothing, least_words=1),
         plain([(r.doc_id, r.text) for r in odd_documents.collect()], [], least=1))


def test_repeated_rows_and_ties(spark, table):
    rows = [(5, "same words " * 15)] * 40 + [(None, "same words " * 15)] * 20 + [(6, None)]
    found = resampling.resample(spark.createDataFrame(rows, "doc_id long, text string"), table("benchmark"),
                                per_cent=50).collect()
    assert len(found) == 61 and sorted(r.rank for r in found if r.rank) == list(range(1, 31))
    best = max(r.score for r in found if r.n_words)
    assert [r.score for r in found if r.rank == 1] == [best]


def test_long_text(spark, table):
    text = "long Text of 3 words, " * 200_000
    documents = [(1, text), (2, "x" * 1_000_000)]
    found = resampling.resample(spark.createDataFrame(documents, "doc_id long, text string"), table("benchmark"))
    same(found, plain(documents, [r.text for r in table("benchmark").collect()]))


def test_query_and_its_sql(spark, table):
    found = queries.queries()["op11_resampling"](spark, "/root/testdata/sf0.001")
    rows = sorted(map(tuple, found.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=key)
    expected = plain([(r.doc_id, r.text) for r in table("documents").collect()], [r.text for r in table("benchmark").collect()])
    assert rows == sorted(expected, key=key)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.001/{name}.parquet'")
    con.execute(queries.oracle_sql()["op11_resampling"])
    names = [d[0] for d in con.description]
    assert sorted(names) == sorted(found.columns)
    by_name = [tuple(r[names.index(c)] for c in found.columns) for r in con.fetchall()]
    assert sorted(by_name, key=key) == sorted(map(tuple, found.collect()), key=key)
