import random
import re

import numpy as np
import pytest
import xxhash

from stallbook.llm import queries, simhash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest key reachable, by comparing everything."""
    component = dict.fromkeys(prints)
    for key in sorted(prints):
        if component[key] is None:
            component[key], queue = key, [key]
            while queue:
                at = queue.pop()
                for other in prints:
                    if component[other] is None and (prints[at] ^ prints[other]).bit_count() <= 3:
                        component[other] = key
                        queue.append(other)
    return component


def test_fingerprints(odd_documents):
    for row in odd_documents.collect():
        assert simhash.fingerprint(row.text) == plain_fingerprint(row.text)


def test_trie_join_finds_every_pair():
    generator = np.random.default_rng(3)
    centres = generator.integers(0, 1 << 64, 20, np.uint64, endpoint=False)
    flips = np.bitwise_or.reduce(np.uint64(1) << generator.integers(0, 64, (3, 400)).astype(np.uint64), axis=0)
    values = np.unique(np.r_[centres[generator.integers(0, 20, 400)] ^ flips, centres, np.uint64(0), np.uint64(7)])
    found = set()
    for i, j in simhash.trie_pairs(values, values, [(0, 0)], 0, 3):
        found |= set(zip(i.tolist(), j.tolist()))
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 3
    assert found == set(zip(*(side.tolist() for side in np.nonzero(near))))


def test_odd_rows(odd_documents):
    rows = simhash.near_duplicates(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    by_print = {}
    for row in odd_documents.collect():
        by_print.setdefault(plain_fingerprint(row.text), []).append(row.doc_id)
    smallest = {fp: min((i for i in ids if i is not None), default=None) for fp, ids in by_print.items()}
    assert {r.fingerprint for r in rows} == {f"{fp:016x}" for fp in by_print}
    zero = [r.component_id for r in rows if r.fingerprint == "0" * 16]
    assert zero == [smallest[0]] * len(by_print[0])


def test_empty_table(no_documents):
    assert simhash.near_duplicates(no_documents).collect() == []


def test_split_subtrees_agree(spark, monkeypatch):
    """Chains and crowds of fingerprints, with subtrees so small that Spark splits them many levels down."""
    chance = random.Random(4)
    values = [chance.getrandbits(64) for _ in range(60)]
    for _ in range(140):
        values.append(chance.choice(values) ^ (1 << chance.randrange(64)) ^ (1 << chance.randrange(8)))
    prints = dict(enumerate(values))
    table = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in set(values)], "fp long")
    monkeypatch.setattr(simhash, "SUBTREE", 4)
    links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(table).collect()]
    roots = {v: v for v in values}

    def root(v):
        while roots[v] != v:
            v = roots[v]
        return v

    for a, b in links:
        assert (a ^ b) and a in roots and b in roots
        roots[root(a)] = root(b)
    expected = plain_components(prints)
    groups = {}
    for key, value in prints.items():
        groups.setdefault(root(value), set()).add(expected[key])
    assert all(len(group) == 1 for group in groups.values())
    assert len(groups) == len(set(expected.values()))


@pytest.mark.parametrize("subtree, batch", [(4096, 1 << 16), (3, 8), (40, 30)])
@pytest.mark.parametrize("radius", [0, 3, 5])
def test_links_are_whole(spark, monkeypatch, subtree, batch, radius):
    """Components as all pairs give them, with crowds at one prefix that are split over and over."""
    generator = np.random.default_rng(radius)
    crowd = np.uint64(0xABCD123456789ABC) ^ generator.integers(0, 1 << 20, 120).astype(np.uint64)
    even = generator.integers(0, 1 << 64, 150, np.uint64)
    near = generator.choice(even, 200) ^ np.bitwise_or.reduce(
        np.uint64(1) << generator.integers(0, 64, (radius + 1, 200)).astype(np.uint64), axis=0)
    values = np.unique(np.r_[crowd, even, near])
    monkeypatch.setattr(simhash, "SUBTREE", subtree)
    monkeypatch.setattr(simhash, "BATCH", batch)
    table = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long").repartition(3)
    labels = np.arange(len(values))
    i, j = np.nonzero(np.bitwise_count(values[:, None] ^ values[None, :]) <= radius)
    simhash.joined_forest(labels, i, j)
    found = np.arange(len(values))
    pairs = np.array([(r.a, r.b) for r in simhash.links(table, radius).collect()], np.int64).reshape(-1, 2).view(np.uint64)
    a, b = np.searchsorted(values, pairs[:, 0]), np.searchsorted(values, pairs[:, 1])
    assert (values[a] == pairs[:, 0]).all() and (values[b] == pairs[:, 1]).all()
    simhash.joined_forest(found, a, b)
    assert (found == labels).all()


def test_a_fingerprint_travels_a_fixed_number_of_times(spark):
    """Rows that meet in the join grow with the table, not faster."""
    generator = np.random.default_rng(9)
    for n in (2000, 20_000):
        values = np.unique(generator.integers(0, 1 << 63, n))
        rows, depth = simhash._turned(spark.createDataFrame([(0, int(v), int(v)) for v in values], "turn int, v long, fp long"), 0, 3)
        assert depth == 16 and rows.count() == 4 * len(values)
        assert simhash._crowded(rows, depth).isEmpty()


def test_query(spark, table):
    rows = queries.queries()["op6_simhash"](spark, "/root/testdata/sf0.001").collect()
    prints = {row.doc_id: plain_fingerprint(row.text) for row in table("documents").collect()}
    expected = plain_components(prints)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == \
        {key: (f"{fp:016x}", expected[key]) for key, fp in prints.items()}
