"""The questions over the small shop, with answers worked out by hand."""

from datetime import date, datetime
from decimal import Decimal as D

import pytest

from stallbook.operators import analytics, matching
from stallbook.plans import questions


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_late_deliveries(typed):
    found = analytics.late_deliveries(typed["orders"], typed["customers"], typed["order_items"], typed["products"])
    # Order 2 came on the promised day itself, in the evening: not late.
    assert sorted(map(str, rows(found))) == sorted(map(str, [
        ("campinas", "pc_gamer"), ("campinas", "beleza"), ("rio de janeiro", None), ("são paulo", "pc_gamer")]))


def test_monthly_revenue(typed):
    assert rows(analytics.monthly_revenue(typed["orders"], typed["payments"])) == [
        (date(2018, 1, 1), D("85.00")), (date(2018, 2, 1), D("11.00")), (date(2018, 3, 1), D("39.75")),
        (date(2018, 4, 1), D("17.00")), (date(2018, 5, 1), D("109.98"))]


def test_category_scores_count_an_order_once_per_category(typed):
    scores = analytics.category_scores(typed["order_items"], typed["products"], typed["order_reviews"], min_reviews=1)
    assert rows(scores) == [
        ("audio", D("2.50"), 2), ("beauty", D("2.80"), 5), ("pc_gamer", D("3.00"), 1)]
    two = analytics.category_scores(typed["order_items"], typed["products"], typed["order_reviews"], min_reviews=2)
    assert [r[0] for r in rows(two)] == ["audio", "beauty"]


def test_seller_ranks(typed):
    assert rows(analytics.seller_ranks(typed["sellers"], typed["order_items"])) == [
        ("s1", "SP", D("1037.75"), 1, 1), ("s3", "PR", D("160.49"), 2, 1), ("s2", "SP", D("91.50"), 3, 2)]


def test_running_spend_breaks_ties_by_order(typed):
    assert rows(analytics.running_spend(typed["orders"], typed["customers"], typed["payments"])) == [
        ("ana", datetime(2018, 1, 1, 10), D("52.50"), D("52.50")),
        ("ana", datetime(2018, 1, 1, 10), D("32.50"), D("85.00")),
        ("ana", datetime(2018, 4, 1, 10), D("17.00"), D("102.00")),
        ("bia", datetime(2018, 2, 1, 9), D("11.00"), D("11.00")),
        ("bia", datetime(2018, 5, 2, 9, 0, 1), D("109.98"), D("120.98")),
        ("davi", datetime(2018, 3, 2, 9), D("32.50"), D("32.50")),
        ("eva", datetime(2018, 3, 3, 9), D("1001.00"), D("1001.00")),
        ("eva", datetime(2018, 3, 4, 9), D("500.00"), D("1501.00")),
        ("gil", datetime(2018, 3, 6, 9), D("7.25"), D("7.25"))]


def test_top_products(typed):
    assert rows(analytics.top_products(typed["order_items"], typed["products"], k=2)) == [
        ("audio", "p2", 3), ("beauty", "p1", 4), ("beauty", "p4", 1), ("pc_gamer", "p3", 2)]


def test_churned(typed):
    # ana came back after exactly 90 days, bia one second later than that, eva the next day.
    found = rows(analytics.churned(typed["orders"], typed["customers"]))
    assert sorted(found) == [
        ("bia", datetime(2018, 2, 1, 9)), ("davi", datetime(2018, 3, 2, 9)),
        ("fabio", datetime(2018, 3, 5, 9)), ("gil", datetime(2018, 3, 6, 9))]
    assert sorted(rows(analytics.churned_by_antijoin(typed["orders"], typed["customers"]))) == sorted(found)


def test_orders_at_the_first_instant_are_no_return(spark):
    when = datetime(2020, 1, 1)
    orders = spark.createDataFrame([("a", when), ("b", when)], "customer_id string, order_purchase_timestamp timestamp_ntz")
    customers = spark.createDataFrame([("a", "x"), ("b", "x")], "customer_id string, customer_unique_id string")
    for churned in (analytics.churned, analytics.churned_by_antijoin):
        assert rows(churned(orders, customers)) == [("x", when)]


def test_top_categories(typed):
    assert rows(analytics.top_categories(typed["order_items"], typed["orders"], typed["products"])) == [
        ("unknown", D("99.99")), ("audio", D("91.50")), ("beauty", D("87.75")), ("pc_gamer", D("10.50"))]


def test_monthly_top_category_keeps_ties(typed):
    assert rows(analytics.monthly_top_category(typed["order_items"], typed["orders"], typed["products"])) == [
        (date(2018, 1, 1), "audio", D("61.00")), (date(2018, 2, 1), "beauty", D("10.00")),
        (date(2018, 3, 1), "beauty", D("50.00")), (date(2018, 4, 1), "beauty", D("7.75")),
        (date(2018, 5, 1), "unknown", D("99.99"))]


def _band(spark, revenues, **limits):
    sellers = spark.createDataFrame([(f"s{i:02}", "SP") for i in range(len(revenues))], "seller_id string, seller_state string")
    items = spark.createDataFrame([("o", f"s{i:02}", D(r)) for i, r in enumerate(revenues)],
                                  "order_id string, seller_id string, price decimal(10,2)")
    orders = spark.createDataFrame([("o", "delivered")], "order_id string, order_status string")
    return [(r["revenue_rank"], r["seller_id"], r["gap_to_10th"], r["gap_pct"])
            for r in analytics.cut_line_band(items, orders, sellers, **limits).collect()]


def test_cut_line_band(spark):
    band = _band(spark, [200 - 10 * i for i in range(20)])
    assert band[0] == (8, "s07", D("-20.00"), D("-18.2")) and band[2] == (10, "s09", D("0.00"), D("0.0"))
    assert band[-1] == (15, "s14", D("50.00"), D("45.5")) and len(band) == 8


def test_cut_line_is_one_value_among_ties(spark):
    # Ranks 1..8, then three sellers tied at 9: none has rank 10, yet place 10 has a revenue.
    band = _band(spark, [200 - 10 * i for i in range(8)] + [100, 100, 100, 50])
    assert [(r, g) for r, _, g, _ in band] == [(8, D("-30.00")), (9, D("0.00")), (9, D("0.00")), (9, D("0.00")), (12, D("50.00"))]
    # A crowd at the cut line is kept whole, each seller once.
    crowd = _band(spark, [200 - 10 * i for i in range(9)] + [10] * 30)
    assert len(crowd) == 32 and {r for r, *_ in crowd} == {8, 9, 10}


def test_cut_line_needs_enough_sellers(spark):
    assert _band(spark, [200 - 10 * i for i in range(9)]) == []
    assert len(_band(spark, [30, 20, 10], cut=2, lo=1, hi=3)) == 3


def test_repeat_share(typed):
    assert rows(analytics.repeat_share(typed["orders"], typed["customers"], typed["payments"])) == [
        ("one-time", 2, D("50.00"), 2, D("19.88")), ("repeat", 2, D("50.00"), 5, D("44.60"))]


def test_delay_vs_score(typed):
    assert rows(analytics.delay_vs_score(typed["orders"], typed["order_reviews"])) == [
        ("a. 8+ days early", 2, D("4.50"), D("0.0")),
        ("b. 1-7 days early", 1, D("1.00"), D("100.0")),
        ("c. on the estimated day", 1, D("4.00"), D("0.0")),
        ("d. 1-7 days late", 1, D("3.00"), D("0.0")),
        ("e. 8+ days late", 1, D("5.00"), D("0.0"))]


@pytest.mark.parametrize("days,label", [(-8, "a"), (-7, "b"), (-1, "b"), (0, "c"), (1, "d"), (7, "d"), (8, "e")])
def test_timing_edges(spark, days, label):
    orders = spark.createDataFrame(
        [("o", "delivered", datetime(2018, 1, 20 + days, 23, 59), date(2018, 1, 20))],
        "order_id string, order_status string, order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date date")
    reviews = spark.createDataFrame([("o", 1)], "order_id string, review_score int")
    found = rows(analytics.delay_vs_score(orders, reviews))
    assert found[0][0].startswith(label) and found[0][3] == D("100.0")


def test_three_ways_to_find_unmatched_rows(spark):
    parents = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    children = spark.createDataFrame([("a",), ("a",), ("z",)], "k string")
    nulls = children.unionByName(spark.createDataFrame([(None,)], "k string"))

    def found(who, method):
        return sorted(str(r[0]) for r in matching.unmatched(parents, who, "k", method=method).collect())

    for method in ("not_exists", "left_null"):
        assert found(children, method) == found(nulls, method) == ["None", "b"]
        assert found(children.limit(0), method) == ["None", "a", "b"]
    assert found(children, "not_in") == ["b"]
    assert found(nulls, "not_in") == []
    assert found(children.limit(0), "not_in") == ["None", "a", "b"]


def test_every_question_runs_by_name(typed):
    assert {name: ask(typed).count() for name, ask in questions.QUESTIONS.items()} == {
        "late_deliveries": 4, "never_ordered": 1, "monthly_revenue": 5, "category_scores": 0, "seller_ranks": 3,
        "running_spend": 9, "top_products": 5, "churned": 4, "top_categories": 4, "monthly_top_category": 5,
        "cut_line_band": 0, "repeat_share": 2, "delay_vs_score": 5}


def test_cut_line_band_ranks_sellers_without_revenue(spark):
    """Ranks are SQL's: two sellers with a NULL revenue share the first place."""
    sellers = spark.createDataFrame([(f"s{k}", "XX") for k in range(14)], "seller_id string, seller_state string")
    orders = spark.createDataFrame([("o", "delivered")], "order_id string, order_status string")
    items = spark.createDataFrame([("o", f"s{k}", None if k < 2 else 100.0 - k) for k in range(14)],
                                  "order_id string, seller_id string, price double")
    found = analytics.cut_line_band(items.withColumn("price", items.price.cast("decimal(10,2)")), orders, sellers, lo=1, hi=5)
    assert [row.revenue_rank for row in found.collect()] == [1, 1, 3, 4, 5]
