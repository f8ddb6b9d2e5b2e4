"""The star-schema tables seen as the retail model, so the operators run on both.

``typed_tables`` gives typed tables for the analytics. ``landed_tables`` gives
all-text tables with the gaps and repetitions the cleaning rules look for, each
derived from the whole of a given table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.operators.matching import lookup_with_fallback
from stallbook.sources.tables import Tables, inline_table, read_tables

# --- fixed values ------------------------------------------------------------
STAR_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
EXCLUDED = ("P",)
DELIVERED = "F"
PROMISED_DAYS = 30
# Two of the six part types have no entry, and one entry is the same word.
TRANSLATION = [("ECONOMY", "economy"), ("LARGE", "large"), ("MEDIUM", "medium"), ("PROMO", "PROMO")]
UNCATEGORISED_BRAND = "Brand#25"
STATUS_NAMES = {"F": "delivered", "O": "shipped", "P": "canceled"}
PAYMENT_NAMES = {"A": "boleto", "N": "credit_card", "R": "voucher"}


def _money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


def _category() -> Column:
    return F.when(F.col("p_brand") != UNCATEGORISED_BRAND, F.col("p_type"))


def _named(column: str, names: dict[str, str]) -> Column:
    chain = F
    for code, name in names.items():
        chain = chain.when(F.col(column) == code, name)
    return chain


def translation(spark: SparkSession) -> DataFrame:
    return inline_table(spark, ["product_category_name", "product_category_name_english"], TRANSLATION)


def typed_tables(spark: SparkSession, folder: str) -> Tables:
    """The analytics tables; a buyer is a customer, a part's type its category."""
    star = read_tables(spark, folder, STAR_TABLES)

    def orders() -> DataFrame:
        return star["orders"].select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
            F.date_add(F.to_date("o_orderdate"), PROMISED_DAYS).alias("order_estimated_delivery_date"))

    def arrived_orders() -> DataFrame:
        # An order has arrived when its last line has; without lines it never did.
        arrivals = star["lineitem"].groupBy(F.col("l_orderkey").alias("order_id")).agg(
            F.max("l_shipdate").alias("order_delivered_customer_date"))
        return orders().join(arrivals, "order_id")

    def customers() -> DataFrame:
        return star["customer"].select(
            F.col("c_custkey").alias("customer_id"), F.col("c_custkey").alias("customer_unique_id"),
            F.col("c_nationkey").alias("customer_zip_code_prefix"), F.col("c_mktsegment").alias("customer_city"),
            F.col("c_nationkey").cast("string").alias("customer_state"))

    def sellers() -> DataFrame:
        return star["supplier"].select(
            F.col("s_suppkey").alias("seller_id"), F.col("s_nationkey").alias("seller_zip_code_prefix"),
            F.col("s_name").alias("seller_city"), F.col("s_nationkey").cast("string").alias("seller_state"))

    def products() -> DataFrame:
        named = star["part"].select(
            F.col("p_partkey").alias("product_id"), _category().alias("product_category_name"),
            F.col("p_size").alias("product_weight_g"))
        return lookup_with_fallback(named, translation(spark), "product_category_name",
                                    "product_category_name_english")

    def order_items() -> DataFrame:
        return star["lineitem"].select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"), _money("l_extendedprice").alias("price"),
            _money("l_tax").alias("freight_value"))

    def payments() -> DataFrame:
        return star["lineitem"].select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("payment_sequential"),
            F.col("l_returnflag").alias("payment_type"), _money("l_extendedprice").alias("payment_value"))

    def order_reviews() -> DataFrame:
        return star["orders"].select(
            F.col("o_orderkey").alias("order_id"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("review_score"))

    return Tables({make.__name__: make for make in (
        orders, arrived_orders, customers, sellers, products, order_items, payments, order_reviews)})


def _text(**columns: Column | str) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).cast("string").alias(name) for name, c in columns.items()]


def landed_tables(spark: SparkSession, folder: str) -> Tables:
    """The raw tables, all text. Here each order has a customer row of its own."""
    star = read_tables(spark, folder, STAR_TABLES)

    def customers() -> DataFrame:
        placed = star["orders"].join(star["customer"], F.col("o_custkey") == F.col("c_custkey"))
        return placed.select(*_text(
            customer_id="o_orderkey", customer_unique_id="o_custkey", customer_zip_code_prefix="c_nationkey",
            customer_city="c_mktsegment", customer_state="c_nationkey"))

    def geolocation() -> DataFrame:
        return star["lineitem"].select(*_text(
            geolocation_zip_code_prefix="l_linenumber", geolocation_lat="l_discount", geolocation_lng="l_tax",
            geolocation_city="l_returnflag", geolocation_state="l_linestatus"))

    def orders() -> DataFrame:
        # Only early lines tell of the handover and only lines not "N" of the
        # delivery, so some orders lack one date, the other, or both.
        dates = star["lineitem"].groupBy("l_orderkey").agg(
            F.min(F.when(F.col("l_linenumber") <= 3, F.col("l_shipdate"))).alias("handover"),
            F.max(F.when(F.col("l_returnflag") != "N", F.col("l_shipdate"))).alias("arrival"))
        dated = star["orders"].join(dates, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        approved = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate"))
        return dated.select(*_text(
            order_id="o_orderkey", customer_id="o_orderkey", order_status=_named("o_orderstatus", STATUS_NAMES),
            order_purchase_timestamp="o_orderdate", order_approved_at=approved,
            order_delivered_carrier_date="handover", order_delivered_customer_date="arrival",
            order_estimated_delivery_date=F.date_add(F.to_date("o_orderdate"), PROMISED_DAYS)))

    def order_items() -> DataFrame:
        return star["lineitem"].select(*_text(
            order_id="l_orderkey", order_item_id="l_linenumber", product_id="l_partkey", seller_id="l_suppkey",
            shipping_limit_date="l_shipdate", price="l_extendedprice", freight_value="l_tax"))

    def order_payments() -> DataFrame:
        return star["lineitem"].select(*_text(
            order_id="l_orderkey", payment_sequential="l_linenumber",
            payment_type=_named("l_returnflag", PAYMENT_NAMES),
            payment_installments=F.col("l_quantity").cast("int"), payment_value="l_extendedprice"))

    def order_reviews() -> DataFrame:
        answered = F.col("l_shipdate") + F.make_dt_interval(days=F.col("l_quantity").cast("int"))
        return star["lineitem"].select(*_text(
            review_id="l_partkey", order_id="l_orderkey", review_score=F.least("l_linenumber", F.lit(5)),
            review_comment_title=F.lit(None), review_comment_message="l_linestatus",
            review_creation_date="l_shipdate", review_answer_timestamp=answered))

    def products() -> DataFrame:
        return star["part"].select(*_text(
            product_id="p_partkey", product_category_name=_category(), product_name_lenght=F.length("p_name"),
            product_description_lenght=F.length("p_brand"), product_photos_qty="p_size", product_weight_g="p_size",
            product_length_cm="p_size", product_height_cm="p_size", product_width_cm="p_size"))

    def sellers() -> DataFrame:
        return star["supplier"].select(*_text(
            seller_id="s_suppkey", seller_zip_code_prefix="s_nationkey", seller_city="s_name",
            seller_state="s_nationkey"))

    def product_category_name_translation() -> DataFrame:
        return translation(spark)

    return Tables({make.__name__: make for make in (
        customers, geolocation, orders, order_items, order_payments, order_reviews, products, sellers,
        product_category_name_translation)})


def planted(typed: Mapping[str, DataFrame]) -> Tables:
    """The typed tables with violations of rules, NOT NULLs and references in them, for the checks to find."""
    made = dict(typed)

    def changed(table: str, **changes: tuple[str, object]) -> None:
        """Columns that take another value, an SQL expression, in the rows that meet a condition."""
        df = made[table]
        made[table] = df.select(*[
            F.expr(f"CASE WHEN {changes[c][0]} THEN {changes[c][1]} ELSE {c} END").cast(df.schema[c].dataType).alias(c)
            if c in changes else F.col(c) for c in df.columns])

    changed("orders", order_approved_at=("order_status = 'shipped'", "order_purchase_timestamp - INTERVAL '1' DAY"),
            order_status=("order_status = 'canceled'", "'lost'"),
            customer_id=("order_status = 'shipped'", "'x' || customer_id"))
    changed("order_items", price=("order_item_id = 2", "-price"), product_id=("order_item_id = 3", "NULL"),
            seller_id=("order_item_id = 4", "'none'"), order_item_id=("order_item_id = 5", "0"))
    changed("payments", payment_value=("payment_sequential = 2", "-payment_value"),
            payment_type=("payment_sequential = 3", "'cash'"), payment_installments=("payment_sequential = 4", "-1"),
            order_id=("payment_sequential = 5", "'none'"))
    changed("order_reviews", review_score=("review_score = 5", "9"), review_creation_date=("review_score = 2", "NULL"),
            review_answer_timestamp=("review_score = 1", "review_creation_date - INTERVAL '1' DAY"))
    changed("geolocation", geolocation_lat=("geolocation_city = 'A'", "91"),
            geolocation_city=("geolocation_city = 'N'", "NULL"))
    changed("sellers", seller_city=("seller_zip_code_prefix < 5", "NULL"))
    return Tables({name: (lambda df=df: df) for name, df in made.items()})


def landed_rows(spark: SparkSession, folder: str) -> dict[str, int]:
    """How many rows each landed table must have; Parquet footers know."""
    star = {name: df.count() for name, df in
            read_tables(spark, folder, ["orders", "lineitem", "part", "supplier"]).items()}
    return {
        "customers": star["orders"], "geolocation": star["lineitem"], "orders": star["orders"],
        "order_items": star["lineitem"], "order_payments": star["lineitem"], "order_reviews": star["lineitem"],
        "products": star["part"], "sellers": star["supplier"],
        "product_category_name_translation": len(TRANSLATION),
    }
