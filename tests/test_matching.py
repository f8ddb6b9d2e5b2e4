import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stallbook.operators import analytics, matching

START = datetime(2017, 12, 20)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def keys(spark, values, name="k"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


@pytest.mark.parametrize("most_bytes", [matching.BITMAP_BYTES, 0])
def test_orphans_by_bitmap(spark, most_bytes):
    """As the anti-join finds them: below, inside and above the parents' range, negative, no number, not in plain form."""
    chance = random.Random(1)
    parents = [str(n) for n in range(-70_000, 70_000) if chance.random() < 0.5] + ["x", None, "7 "]
    children = [str(chance.randrange(-90_000, 90_000)) for _ in range(5000)] + ["x", "y", None, "007", "+7", "7", "-0", "", "7 "] * 2
    children += ["9223372036854775807", "-9223372036854775808", "9223372036854775808"]
    c, p = keys(spark, children), keys(spark, parents, "p")
    found = matching.orphans_by_bitmap(c, "k", p, "p", most_bytes)
    assert rows(found) == rows(matching.orphans(c, "k", p, "p")) and found.count() > 1000


def test_orphans_by_bitmap_of_numbers(spark):
    c, p = spark.range(100).selectExpr("CAST(id % 40 AS INT) AS k"), spark.range(30, 35).toDF("k")
    assert rows(matching.orphans_by_bitmap(c, "k", p)) == rows(matching.orphans(c, "k", p))
    assert rows(matching.orphans_by_bitmap(c, "k", p.where("false"))) == rows(matching.orphans(c, "k", p.where("false")))
    assert matching.orphans_by_bitmap(c.where("false"), "k", p).collect() == []


def test_only_candidates_are_shuffled(spark):
    """100,000 children send a few bitmaps; of their rows none travels but the orphans', once per task."""
    children = spark.range(0, 100_000, 1, 4).selectExpr("id % 5000 AS k")
    parents = spark.range(4990).toDF("k")
    found = matching.orphans_by_bitmap(children, "k", parents)
    assert rows(found) == [(k, 20) for k in range(4990, 5000)]

    def exchanged(plan):
        while plan.nodeName().startswith("AdaptiveSparkPlan"):
            plan = plan.executedPlan()
        if "QueryStage" in plan.nodeName():
            return exchanged(plan.plan())
        below = [exchanged(plan.children().apply(i)) for i in range(plan.children().size())]
        mine = plan.metrics().apply("shuffleRecordsWritten").value() if plan.nodeName() == "Exchange" else 0
        return mine + sum(below)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20KB")     # the parents are too many for it
    found = matching.orphans_by_bitmap(children, "k", parents)
    found.collect()
    plain = matching.orphans(children, "k", parents)
    plain.collect()
    assert exchanged(found._jdf.queryExecution().executedPlan()) < 100
    assert exchanged(plain._jdf.queryExecution().executedPlan()) > 10_000
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plain_followers(df, others, days):
    def follows(k, t):
        return k is not None and t is not None and any(
            c == k and u is not None and t < u <= t + timedelta(days=days) for c, u in others)

    return sorted((r for r in df if not follows(*r)), key=repr)


@pytest.mark.parametrize("days", [1, 7, 90])
def test_without_follower(spark, days):
    chance = random.Random(days)

    def draw(n):
        hours = [0, 1, 24 * days, 24 * days - 1, 24 * days + 1]
        return [(chance.choice(["a", "b", "c", None]), None if chance.random() < 0.05 else START + timedelta(
            days=chance.randrange(-400, 400), hours=chance.choice(hours))) for _ in range(n)]

    df, others = draw(300), draw(200)
    others += [(k, t + timedelta(days=days)) for k, t in df[:40] if t] + df[40:80]
    schema = "k string, t timestamp_ntz"
    found = matching.without_follower(spark.createDataFrame(df, schema), spark.createDataFrame(others, schema), "k", "t", days)
    assert rows(found) == plain_followers(df, others, days)


def test_a_hot_person_is_spread(spark):
    """A person with most orders: one row per bin and task is shuffled, and the bins lie in different partitions."""
    orders = spark.range(0, 60_000, 1, 4).select(
        F.col("id").cast("string").alias("order_id"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 97).cast("string"))).alias("customer_id"),
        F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit(START)).cast("timestamp_ntz").alias("order_purchase_timestamp"))
    customers = orders.select("customer_id", F.col("customer_id").alias("customer_unique_id")).distinct()
    expected = rows(analytics.churned(orders, customers, 10))
    assert rows(analytics.churned_by_antijoin(orders, customers, 10)) == expected
    bins = orders.where("customer_id = 'hot'").groupBy(
        "customer_id", F.floor(F.date_diff(F.to_date("order_purchase_timestamp"), F.lit("1970-01-01").cast("date")) / 10))
    counted = bins.count()
    assert counted.count() > 200
    assert len({r[0] for r in bins.count().repartition(8, *counted.columns[:2]).select(F.spark_partition_id()).collect()}) == 8
