"""Nearest rows by the pivot index and by blocks of seeds: as the plain scan finds them, and reading less."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallbook.functions.vectors import METRICS
from stallbook.operators import knn, search
from stallbook.operators.pivots import PivotIndex

SCHEMA = "order_id long, embedding array<float>"


def frame(spark, data):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v])
                                  for i, v in enumerate(data)], SCHEMA).repartition(4)


def clusters(rng, groups, each, width=16):
    centres = rng.normal(size=(groups, width)) * rng.uniform(1, 6, size=(groups, 1))
    return (centres[:, None] + rng.normal(scale=0.05, size=(groups, each, width))).reshape(-1, width).astype("float32")


ODD = [None, [0.0] * 16, [1.0] * 3, [], [float("nan")] * 16, [float("inf")] + [0.0] * 15, [None] + [1.0] * 15]


def close(found):
    return [(r.order_id, pytest.approx(r.distance, abs=1e-9)) for r in found.collect()]


def pairs(found):
    return [(r.order_id, r.distance) for r in found.collect()]


def scanned(df):
    """Rows that the scan gave on, after skipping row groups and pages, as the executed plan's metrics say."""
    df.collect()

    def leaves(plan):
        if plan.nodeName().startswith("AdaptiveSparkPlan"):
            return leaves(plan.executedPlan())
        below = plan.children()
        parts = [leaves(below.apply(i)) for i in range(below.size())]
        return sum(parts, []) or [plan]

    total = 0
    for leaf in leaves(df._jdf.queryExecution().executedPlan()):
        if "QueryStage" in leaf.nodeName():
            total += sum(x.metrics().apply("numOutputRows").value() for x in leaves(leaf.plan()))
        else:
            total += leaf.metrics().apply("numOutputRows").value()
    return total


@pytest.fixture(scope="module", params=["clusters", "even"])
def data(request):
    rng = np.random.default_rng(3)
    rows = clusters(rng, 30, 100) if request.param == "clusters" else rng.normal(size=(800, 16)).astype("float32")
    return [*rows, *rows[:5], *ODD]


@pytest.fixture(scope="module")
def index(spark, data, tmp_path_factory):
    return PivotIndex.build(frame(spark, data), str(tmp_path_factory.mktemp("index")), row_group_bytes=8192)


@pytest.mark.parametrize("metric", METRICS)
def test_index_equals_scan(spark, data, index, metric):
    df = frame(spark, data)
    for seed in (0, 17, 555, len(data) - 9, *range(len(data) - len(ODD), len(data))):
        expected = search.nearest(df, seed, k=7, metric=metric)
        if seed == len(data) - 6 and metric == "cosine":
            assert expected.collect() == []                    # no direction, no cosine
        assert close(index.nearest(seed, k=7, metric=metric)) == pairs(expected), (metric, seed)
    assert index.nearest(10 ** 9).collect() == []


@pytest.mark.parametrize("metric", METRICS)
def test_index_skips_row_groups(spark, tmp_path, metric):
    """On rows in clusters, nearly all of the table is left unread."""
    rng = np.random.default_rng(4)
    data = clusters(rng, 40, 200)
    index = PivotIndex.build(frame(spark, data), str(tmp_path), row_group_bytes=8192)
    longest = int(np.linalg.norm(data, axis=1).argmax())
    found = index.nearest(longest, k=5, metric=metric)
    assert len(found.collect()) == 5
    assert scanned(found) < 0.25 * len(data)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "to_0" in plan[plan.index("PushedFilters"):]


def test_index_refuses_clashing_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="own"):
        PivotIndex.build(frame(spark, [[1.0]]).withColumn("norm", F.lit(1)), str(tmp_path))


def test_index_of_nothing(spark, tmp_path):
    index = PivotIndex.build(frame(spark, []), str(tmp_path))
    assert index.nearest(1).collect() == []


def plain(data, seeds, k, metric):
    found = []
    for s in seeds:
        if data[s] is None or None in data[s] or not np.isfinite(np.array(data[s], float)).all():
            continue
        a, apart = np.array(data[s], float), []
        for i, v in enumerate(data):
            if v is None or None in v or len(v) != len(a) or not np.isfinite(np.array(v, float)).all():
                continue
            b = np.array(v, float)
            if metric == "cosine" and not (a.any() and b.any()):
                continue
            d = {"l2": lambda: np.sqrt(np.square(a - b).sum()), "inner_product": lambda: -(a * b).sum(),
                 "cosine": lambda: 1 - (a * b).sum() / (np.sqrt(np.square(a).sum()) * np.sqrt(np.square(b).sum()))}[metric]()
            apart.append((float(d), i))
        found += [(s, i, pytest.approx(d, abs=1e-9), n + 1) for n, (d, i) in enumerate(sorted(apart)[:k])]
    return found


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("turn_bytes", [1 << 20, 128 * 9])
def test_nearest_to_each(spark, data, metric, turn_bytes):
    """As all pairs give it, in one turn or many, copies and odd rows included."""
    seeds = sorted({*range(0, len(data), 97), *range(len(data) - len(ODD), len(data))})
    df = frame(spark, data)
    found = knn.nearest_to_each(df, df.where(F.col("order_id").isin(seeds)), 4, metric, turn_bytes=turn_bytes)
    rows = sorted((r.seed, r.position, r.order_id, r.distance) for r in found.collect())
    assert [(s, i, d, n) for s, n, i, d in rows] == plain(data, seeds, 4, metric)


def test_crowd_of_copies(spark):
    """More copies than k at one place: the smallest keys win."""
    df = frame(spark, [[1.0, 2.0, 3.0]] * 3000 + [[3.0, 2.0, 1.0]] * 10)
    found = knn.nearest_to_each(df, df.where("order_id IN (7, 3005)"), 3, "l2")
    assert sorted((r.seed, r.position, r.order_id) for r in found.collect()) == [
        (7, 1, 0), (7, 2, 1), (7, 3, 2), (3005, 1, 3000), (3005, 2, 3001), (3005, 3, 3002)]
    assert knn.nearest_to_each(df, df.where("false"), 3).collect() == []
    named = df.select(F.format_string("key%05d", "order_id").alias("order_id"), "embedding")
    found = knn.nearest_to_each(named, named.where("order_id = 'key00007'"), 2)
    assert sorted(r.order_id for r in found.collect()) == ["key00000", "key00001"]


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("copies", [False, True])
def test_nearest_to_each_in_bounded_memory(metric, copies):
    """Only a bounded number of candidates is worked out at once, also before any bound is known and among copies."""
    import tracemalloc

    rng = np.random.default_rng(5)
    rows = np.ones((512, 64)) if copies else rng.normal(size=(512, 64)).astype("float32").astype(float)
    best = knn._Best(np.arange(512), rows, 3, metric)
    tracemalloc.start()
    best.see(np.arange(512), rows)
    best.see(np.arange(512, 1024), rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20
    found = {seed: [] for seed in range(512)}
    for who, apart, keys in best.found.values():
        for seed, distance, key in zip(who.tolist(), apart.tolist(), keys.tolist()):
            found[seed].append((distance, key))
    every = [(i, v) for i, v in enumerate(np.concatenate([rows, rows]))]
    for seed in (0, 17, 511):
        apart = knn._exact(metric, np.broadcast_to(rows[seed], (1024, 64)), np.array([v for _, v in every]))
        assert found[seed] == sorted(zip(apart.tolist(), range(1024)))[:3]
