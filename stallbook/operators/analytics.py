"""The analytics questions, over the typed tables.

Where a sum and the join after it share their key, the facts are summed first: a
hot key is then one row in the join, and the join needs no exchange beyond the
one the sum already made.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallbook.functions import dates, numbers
from stallbook.operators import matching, ordered
from stallbook.operators.matching import distinct_keys
from stallbook.sources.shared import pinned

# --- fixed values ------------------------------------------------------------
EXCLUDED_STATUSES = ("canceled", "unavailable")
DELIVERED = "delivered"
UNKNOWN_CATEGORY = "unknown"
ONE_TIME, REPEAT = "one-time", "repeat"
TIMING_LABELS = (
    "a. 8+ days early",
    "b. 1-7 days early",
    "c. on the estimated day",
    "d. 1-7 days late",
    "e. 8+ days late",
)

_CATEGORY = "product_category_name_english"


def _kept(orders: DataFrame, exclude_status: Sequence[str]) -> DataFrame:
    return orders.where(~F.col("order_status").isin(*exclude_status))


def _order_totals(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(F.sum("payment_value").alias("order_total"))


def _persons(customers: DataFrame) -> DataFrame:
    """``customer_id`` belongs to an order; the person is ``customer_unique_id``."""
    return customers.select("customer_id", "customer_unique_id")


def late_deliveries(orders: DataFrame, customers: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """City and category of every order line that arrived after the promised day."""
    late = orders.where(dates.later_day("order_delivered_customer_date", "order_estimated_delivery_date"))
    return (late.select("order_id", "customer_id")
            .join(customers.select("customer_id", "customer_city"), "customer_id")
            .join(items.select("order_id", "product_id"), "order_id")
            .join(products.select("product_id", "product_category_name"), "product_id")
            .select("customer_city", "product_category_name"))


def monthly_revenue(orders: DataFrame, payments: DataFrame,
                    exclude_status: Sequence[str] = EXCLUDED_STATUSES) -> DataFrame:
    """Payments per month of purchase; a month without any has no row."""
    kept = _kept(orders, exclude_status).select(
        "order_id", dates.month_of("order_purchase_timestamp").alias("months"))
    return (_order_totals(payments).join(kept, "order_id")
            .groupBy("months").agg(F.sum("order_total").alias("revenue"))
            .orderBy(F.col("months").asc_nulls_last()))


def category_scores(items: DataFrame, products: DataFrame, reviews: DataFrame, min_reviews: int = 20) -> DataFrame:
    """Mean review per category, worst first; an order votes once per category."""
    known = products.where(F.col(_CATEGORY).isNotNull()).select("product_id", F.col(_CATEGORY).alias("category"))
    # One exchange by order serves the votes and the join; an order has few categories.
    votes = (items.select("order_id", "product_id").join(known, "product_id")
             .groupBy("order_id").agg(F.collect_set("category").alias("categories"))
             .select("order_id", F.explode("categories").alias("category")))
    return (votes.join(reviews.select("order_id", "review_score"), "order_id")
            .groupBy("category")
            .agg(numbers.mean("review_score", 2).alias("avg_score"), F.count(F.lit(1)).alias("reviews"))
            .where(F.col("reviews") >= min_reviews)
            .orderBy(F.col("avg_score").asc_nulls_last(), F.desc("reviews"), "category"))


def seller_ranks(sellers: DataFrame, items: DataFrame) -> DataFrame:
    """Sellers by revenue, ranked overall and within their state."""
    sold = items.groupBy("seller_id").agg(F.sum("price").alias("total_revenue"))
    revenue = sellers.select("seller_id", "seller_state").join(sold, "seller_id")
    ranked = ordered.with_ranks(pinned(revenue), "total_revenue", {"overall_rank": [], "state_rank": ["seller_state"]})
    return ranked.orderBy("overall_rank", "seller_id")


def running_spend(orders: DataFrame, customers: DataFrame, payments: DataFrame) -> DataFrame:
    """Each person's orders in time, with what they had spent by then."""
    purchases = orders.select("order_id", "customer_id", "order_purchase_timestamp")
    spend = (_order_totals(payments).join(purchases, "order_id")
             .join(_persons(customers), "customer_id")
             .select("order_id", "customer_unique_id", "order_purchase_timestamp", "order_total"))
    # Two orders at the same moment are told apart by their id.
    in_time = [F.col("order_purchase_timestamp").asc_nulls_last(), F.col("order_id").asc_nulls_last()]
    return (ordered.split_running_sum(spend, ["customer_unique_id"], in_time, "order_total", "running_total")
            .orderBy(F.col("customer_unique_id").asc_nulls_last(), *in_time)
            .select("customer_unique_id", "order_purchase_timestamp", "order_total", "running_total"))


def top_products(items: DataFrame, products: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` products of each category with the most lines sold."""
    sold = items.groupBy("product_id").agg(F.count(F.lit(1)).alias("sold_count"))
    known = products.where(F.col(_CATEGORY).isNotNull()).select("product_id", F.col(_CATEGORY).alias("category"))
    best_first = [F.desc("sold_count"), F.col("product_id").asc()]
    return (ordered.top_per_group(sold.join(known, "product_id"), ["category"], best_first, k)
            .orderBy("category", "position")
            .select("category", "product_id", "sold_count"))


def churned(orders: DataFrame, customers: DataFrame, horizon_days: int = 90) -> DataFrame:
    """Persons who placed no order in the ``horizon_days`` after their first.

    A person churned if their second distinct order time is missing or too
    late, so the two earliest times decide. Copies of a time vanish in the
    partial ``distinct``, and each task passes on two rows per person.
    """
    times = (orders.select("customer_id", F.col("order_purchase_timestamp").alias("ts"))
             .where(F.col("ts").isNotNull())
             .join(_persons(customers), "customer_id")
             .select(F.col("customer_unique_id").alias("customer"), "ts").distinct())
    earliest = ordered.top_per_group(times, ["customer"], [F.col("ts").asc()], 2)
    first, last = F.col("first_ts"), F.col("last_ts")
    returned = (last > first) & (last <= dates.shift(first, timedelta(days=horizon_days)))
    return (earliest.groupBy("customer").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
            .where(~returned).select("customer", "first_ts"))


def churned_by_antijoin(orders: DataFrame, customers: DataFrame, horizon_days: int = 90) -> DataFrame:
    """The same persons, by looking for an order inside each one's horizon.

    Kept to check ``churned``, which needs no second pass over the orders.
    """
    times = (orders.select("customer_id", F.col("order_purchase_timestamp").alias("ts"))
             .join(_persons(customers), "customer_id")
             .select(F.col("customer_unique_id").alias("customer"), "ts"))
    firsts = times.groupBy("customer").agg(F.min("ts").alias("first_ts")).where(F.col("first_ts").isNotNull())
    return matching.without_follower(firsts, times, "customer", "first_ts", horizon_days, other_at="ts")


def _sales(items: DataFrame, orders: DataFrame, exclude_status: Sequence[str], *period: Column) -> DataFrame:
    """Lines of the orders that count, with the period of their purchase if asked for."""
    kept = _kept(orders, exclude_status).select("order_id", *period)
    return items.select("order_id", "product_id", "price").join(kept, "order_id").drop("order_id")


def _categories(products: DataFrame) -> DataFrame:
    return products.select("product_id", F.coalesce(_CATEGORY, F.lit(UNKNOWN_CATEGORY)).alias("category"))


def top_categories(items: DataFrame, orders: DataFrame, products: DataFrame, k: int = 10,
                   exclude_status: Sequence[str] = EXCLUDED_STATUSES) -> DataFrame:
    """The ``k`` categories that earned most."""
    # Summed per product first, so the join takes one row per product.
    per_product = _sales(items, orders, exclude_status).groupBy("product_id").agg(F.sum("price").alias("revenue"))
    return (per_product.join(_categories(products), "product_id")
            .groupBy("category").agg(F.sum("revenue").alias("revenue"))
            .orderBy(F.desc("revenue"), "category").limit(k))


def monthly_top_category(items: DataFrame, orders: DataFrame, products: DataFrame,
                         exclude_status: Sequence[str] = EXCLUDED_STATUSES) -> DataFrame:
    """The category, or tied categories, that earned most in each month."""
    # A product sells in most months, so summing per product and month first
    # would add an exchange and hardly save a row.
    month = dates.month_of("order_purchase_timestamp").alias("month")
    monthly = (_sales(items, orders, exclude_status, month).join(_categories(products), "product_id")
               .groupBy("month", "category").agg(F.sum("price").alias("revenue")))
    return ordered.winners(monthly, ["month"], "revenue").orderBy(F.col("month").asc_nulls_last(), "category")


def cut_line_band(items: DataFrame, orders: DataFrame, sellers: DataFrame,
                  cut: int = 10, lo: int = 8, hi: int = 15,
                  exclude_status: Sequence[str] = EXCLUDED_STATUSES) -> DataFrame:
    """Sellers ranked ``lo`` to ``hi``, with their gap to the one in place ``cut``.

    The gap is negative above the cut line. The line is the revenue in place
    ``cut``, which is one value also when sellers tie around it; with fewer
    sellers than that there is no line and no row.
    """
    kept = _kept(orders, exclude_status).select("order_id")
    earned = (items.select("order_id", "seller_id", "price").join(kept, "order_id")
              .groupBy("seller_id").agg(F.sum("price").alias("revenue")))
    down = Window.orderBy(F.col("revenue").desc_nulls_first())
    last = max(cut, hi)
    # Ranks up to ``last`` lie among as many largest distinct values, which
    # is a handful of rows however many sellers share one of them.
    earned = pinned(earned)
    values = (earned.groupBy("revenue").agg(F.count(F.lit(1)).alias("_n"))
              .orderBy(F.col("revenue").desc_nulls_first()).limit(last))
    above = F.sum("_n").over(down.rowsBetween(Window.unboundedPreceding, -1))
    places = values.withColumn("revenue_rank", F.coalesce(above, F.lit(0)) + 1)
    held = _band(places, cut, lo, hi).withColumnRenamed("revenue", "_held")
    # Sellers without a revenue are ranked too, so NULL meets NULL here.
    band = earned.join(F.broadcast(held), F.col("revenue").eqNullSafe(F.col("_held"))).drop("_held")
    gap = F.col("tenth") - F.col("revenue")
    return (band.join(sellers.select("seller_id", "seller_state"), "seller_id")
            .select("revenue_rank", "seller_id", "seller_state", "revenue", gap.alias("gap_to_10th"),
                    numbers.percent(gap, F.col("tenth"), 1).alias("gap_pct"))
            .orderBy("revenue_rank", "seller_id"))


def _band(places: DataFrame, cut: int, lo: int, hi: int) -> DataFrame:
    """The places ranked ``lo`` to ``hi`` with the revenue in place ``cut``.

    A place is a revenue held by ``_n`` sellers.
    """
    everyone = Window.partitionBy(F.lit(1))
    inside = F.col("revenue_rank") <= cut
    return (places.withColumn("tenth", F.min(F.when(inside, F.col("revenue"))).over(everyone))
            .withColumn("_inside", F.sum(F.when(inside, F.col("_n"))).over(everyone))
            .where((F.col("_inside") >= cut) & F.col("revenue_rank").between(lo, hi))
            .drop("_n", "_inside"))


def repeat_share(orders: DataFrame, customers: DataFrame, payments: DataFrame,
                 exclude_status: Sequence[str] = EXCLUDED_STATUSES) -> DataFrame:
    """One-time and repeat buyers: how many, and what an order of theirs is worth."""
    kept = _kept(orders, exclude_status).select("order_id", "customer_id")
    per_customer = (_order_totals(payments).join(kept, "order_id")
                    .groupBy("customer_id")
                    .agg(F.count(F.lit(1)).alias("orders"), F.sum("order_total").alias("spend")))
    per_person = (per_customer.join(_persons(customers), "customer_id")
                  .groupBy("customer_unique_id")
                  .agg(F.sum("orders").alias("orders"), F.sum("spend").alias("spend")))
    kind = F.when(F.col("orders") == 1, ONE_TIME).otherwise(REPEAT)
    per_kind = per_person.groupBy(kind.alias("customer_type")).agg(
        F.count(F.lit(1)).alias("customers"), F.sum("orders").alias("num_orders"), F.sum("spend").alias("spend"))
    everyone = F.sum("customers").over(Window.partitionBy(F.lit(1)))
    return (per_kind.select(
        "customer_type", "customers",
        numbers.percent(F.col("customers"), everyone, 2).alias("pct_of_customers"),
        "num_orders",
        F.round(numbers.ratio(F.col("spend"), F.col("num_orders")), 2).alias("avg_order_value"))
        .orderBy("customer_type"))


def delay_vs_score(orders: DataFrame, reviews: DataFrame, week: int = 7, delivered: str = DELIVERED) -> DataFrame:
    """Delivered orders by how early or late they came, and how they were rated."""
    early, bit_early, on_day, bit_late, late = TIMING_LABELS
    days = F.col("days_late")
    timing = (F.when(days < -week, early).when(days < 0, bit_early).when(days == 0, on_day)
              .when(days <= week, bit_late).otherwise(late))
    arrived = (orders.where((F.col("order_status") == delivered) & F.col("order_delivered_customer_date").isNotNull())
               .select("order_id", dates.days_between("order_delivered_customer_date",
                                                      "order_estimated_delivery_date").alias("days_late")))
    return (arrived.join(reviews.select("order_id", "review_score"), "order_id")
            .groupBy(timing.alias("delivery_timing"))
            .agg(F.count(F.lit(1)).alias("orders"),
                 numbers.mean("review_score", 2).alias("avg_review_score"),
                 numbers.percent(F.count_if(F.col("review_score") == 1), F.count(F.lit(1)), 1).alias("pct_one_star"))
            .orderBy("delivery_timing"))


def never_ordered(products: DataFrame, items: DataFrame) -> DataFrame:
    """Products on no order line."""
    return products.select("product_id").join(distinct_keys(items, "product_id"), "product_id", "left_anti")
