"""Split and ordinary windows give the same rows, whatever the groups."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stallbook.operators import ordered

SCHEMA = "g string, t int, id int, v int"


def _data(spark, seed, groups, rows=600):
    rng = random.Random(seed)
    # A third of the rows in one group, some in the NULL group, times that repeat.
    names = [None] + [f"g{i}" for i in range(groups)]
    data = [("hot" if rng.random() < 0.34 else rng.choice(names), rng.randrange(40), i, rng.randrange(-5, 50))
            for i in range(rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(4)


def _sorted(df, columns):
    return sorted(map(repr, map(tuple, df.select(*columns).collect())))


@pytest.mark.parametrize("seed,groups", [(1, 3), (2, 50), (3, 1)])
def test_split_running_sum(spark, seed, groups):
    df = _data(spark, seed, groups)
    order = [F.col("t").asc(), F.col("id").asc()]
    w = Window.partitionBy("g").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    columns = [*df.columns, "s"]
    assert (_sorted(ordered.split_running_sum(df, ["g"], order, "v", "s"), columns)
            == _sorted(df.withColumn("s", F.sum("v").over(w)), columns))


def test_split_running_sum_without_groups(spark):
    df = _data(spark, 4, 5)
    order = [F.col("t").desc(), F.col("id").asc()]
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    columns = [*df.columns, "s"]
    assert (_sorted(ordered.split_running_sum(df, [], order, "v", "s"), columns)
            == _sorted(df.withColumn("s", F.sum("v").over(w)), columns))


@pytest.mark.parametrize("by", [[], ["g"]])
def test_split_rank_equals_window_rank(spark, by):
    df = _data(spark, 6, 4)
    columns = [*df.columns, "r"]
    plain = F.rank().over(Window.partitionBy(*by).orderBy(F.col("v").desc_nulls_first())).cast("long")
    assert _sorted(ordered.with_ranks(df, "v", {"r": by}), columns) == _sorted(df.withColumn("r", plain), columns)


def test_winners_keep_ties(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", 1)], "g string, v int")
    assert _sorted(ordered.winners(df, ["g"], "v"), ["g", "v"]) == ["('a', 2)", "('a', 2)", "('b', 1)"]


def test_top_per_group_prunes_before_the_shuffle(spark):
    df = _data(spark, 7, 4)
    top = ordered.top_per_group(df, ["g"], [F.desc("v"), F.asc("id")], 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.count("WindowGroupLimit") == 2
