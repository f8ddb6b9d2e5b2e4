import itertools

import numpy as np

from stallbook.llm import lattice, queries

SCHEMA = "vec_id long, embedding array<float>, label int, node string"


def brute(rows, threshold=0.93):
    """{id: (links, component)} and the linked pairs, by comparing everything."""
    good = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and None not in r[1]
            and np.isfinite(np.array(r[1], float)).all() and any(r[1])]
    links, root = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    pairs = 0
    for label in {(r[2], len(r[1])) for r in good}:
        mine = [r for r in good if (r[2], len(r[1])) == label]
        x = np.array([r[1] for r in mine], np.float32).astype(float)
        x /= np.linalg.norm(x, axis=1)[:, None]
        for i, j in np.argwhere(np.triu(x @ x.T >= threshold, 1)):
            a, b = mine[i][0], mine[j][0]
            pairs += 1
            links[a] += 1
            links[b] += 1
            root[max(top(a), top(b))] = min(top(a), top(b))
    return {k: (links[k], top(k)) for k in links}, pairs


def test_nearest_point_is_nearest():
    x = np.random.default_rng(1).normal(size=(200, 8)) * 3
    point = lattice.nearest_point(x)
    doubled = 2 * point
    assert (doubled == np.rint(doubled)).all() and (point.sum(1) % 2 == 0).all()
    assert len(lattice.NEIGHBOURS) == 240
    here = ((x - point) ** 2).sum(1)
    for step in lattice.NEIGHBOURS:
        assert (((x - point - step) ** 2).sum(1) >= here - 1e-9).all()


def data(seed, n=900, dim=64):
    """Random vectors, and neighbours of some of them at cosines around the threshold, in three labels."""
    generator = np.random.default_rng(seed)
    x = generator.normal(size=(n, dim))
    for k in range(n // 3, n):
        cosine = generator.choice([0.90, 0.935, 0.95, 0.99])
        base = x[generator.integers(0, n // 3)] if k % 5 else x[0]
        base = base / np.linalg.norm(base)
        side = x[k] - (x[k] @ base) * base
        x[k] = (cosine * base + np.sqrt(1 - cosine ** 2) * side / np.linalg.norm(side)) * generator.uniform(0.1, 9)
    return [(k, x[k].astype(np.float32).tolist(), int(generator.integers(0, 2)) if k % 3 else 0, "c") for k in range(n)]


def measured(spark, rows):
    expected, pairs = brute(rows)
    found = {r.id: r for r in lattice.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(r.n_links <= expected[k][0] for k, r in found.items())
    assert all(r.kept == (r.component_id == k) for k, r in found.items())
    return sum(r.n_links for r in found.values()) / (2 * pairs), \
        np.mean([r.component_id == expected[k][1] for k, r in found.items()])


def test_recall(spark):
    recall, same = measured(spark, data(2))
    assert recall > 0.97 and same > 0.97


def test_crowded_cells_in_blocks(spark, monkeypatch):
    rows = data(3)
    whole = sorted(lattice.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    monkeypatch.setattr(lattice, "TILE", 200)
    assert sorted(lattice.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()) == whole


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.0], 1, "c"), (2, [2.0, 0.0, 0.0], 1, "c"), (3, [1.0, 0.0, 0.0], 1, "c"), (3, [1.0, 0.0, 0.0], 1, "c"),
            (4, [1.0, 0.0, 0.0], 2, "c"), (5, [1.0, 0.0, 0.0], None, "c"), (6, [1.0, 0.0], 1, "c"), (7, None, 1, "c"), (8, [], 1, "c"),
            (9, [0.0, 0.0, 0.0], 1, "c"), (10, [1.0, None, 0.0], 1, "c"), (11, [1.0, nan, 0.0], 1, "c"), (12, [inf, 0.0, 0.0], 1, "c"),
            (None, [1.0, 0.0, 0.0], 1, "c"), (13, [-1.0, 0.0, 0.0], 1, "c"), (14, [1e30, 0.0, 0.0], 1, None)]
    table = spark.createDataFrame(rows, SCHEMA)
    found = [(r.id, r.n_links, r.component_id) for r in lattice.near_duplicates(table).collect()]
    linked = [(1, 4, 1), (2, 4, 1), (3, 4, 1), (3, 4, 1), (14, 4, 1)]
    alone = [(k, 0, k) for k in (4, 5, 6, 7, 8, 9, 10, 11, 12, 13)]
    assert sorted(found, key=repr) == sorted([*linked, *alone, (None, 0, None)], key=repr)
    assert lattice.near_duplicates(table.where("false")).collect() == []


def test_query(spark, table):
    rows = [tuple(r) for r in table("embeddings").select("vec_id", "embedding", "label").collect()]
    expected, pairs = brute(rows)
    found = {r.vec_id: r for r in queries.queries()["op2_embeddings"](spark, "/root/testdata/sf0.001").collect()}
    assert found.keys() == expected.keys()
    assert sum(r.n_links for r in found.values()) >= 0.97 * 2 * pairs
    assert all(r.n_links <= expected[k][0] for k, r in found.items())


def test_minimal_vectors_are_all():
    lengths = {round(float((v ** 2).sum()), 6) for v in lattice.NEIGHBOURS}
    assert lengths == {2.0}
    assert len({tuple(v) for v in lattice.NEIGHBOURS}) == 240
    assert all((a + b).sum() % 2 == 0 for a, b in itertools.islice(itertools.combinations(lattice.NEIGHBOURS, 2), 500))
