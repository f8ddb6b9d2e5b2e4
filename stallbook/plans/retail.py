"""From raw files to checked, published tables."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook import schemas
from stallbook.operators import cleaning, ordered, quality
from stallbook.operators.matching import lookup_with_fallback
from stallbook.sources import csv_files, tables
from stallbook.sources.shared import pinned

# --- fixed values ------------------------------------------------------------
DELIVERED = "delivered"
# Median handover-to-customer time: 7.1 days.
HANDOVER_TO_CUSTOMER = timedelta(days=7, hours=2, minutes=24)
# Source noise that cleaning leaves in place: orders delivered before handover.
DELIVERED_BEFORE_HANDOVER = 23
LANDED_ROWS = {
    "customers": 99441, "geolocation": 1000163, "orders": 99441,
    "order_items": 112650, "order_payments": 103886, "order_reviews": 99224,
    "products": 32951, "sellers": 3095, "product_category_name_translation": 71,
}
TYPED_ROWS = {
    "customers": 99440, "geolocation": 738332, "sellers": 3095,
    "product_category_translation": 71, "products": 32951, "orders": 99440,
    "order_items": 112649, "payments": 103885, "order_reviews": 98672,
}
IMPUTED_ORDERS, UNDELIVERED_ORDERS, FALLBACK_PRODUCTS = 7, 2957, 13

TABLES = list(schemas.TYPED_COLUMNS)
# Typed name -> the name it was landed under.
MISSPELT_COLUMNS = {"product_name_length": "product_name_lenght",
                    "product_description_length": "product_description_lenght"}


@dataclass(frozen=True)
class Expectations:
    """What the gates demand of one snapshot; the defaults are the published one's."""

    landed_rows: dict[str, int] = field(default_factory=lambda: dict(LANDED_ROWS))
    typed_rows: dict[str, int] = field(default_factory=lambda: dict(TYPED_ROWS))
    imputed_orders: int = IMPUTED_ORDERS
    undelivered_orders: int = UNDELIVERED_ORDERS
    fallback_products: int = FALLBACK_PRODUCTS
    delivered_before_handover: int = DELIVERED_BEFORE_HANDOVER


def unusable_orders(orders: DataFrame, delivered: str = DELIVERED) -> DataFrame:
    """Delivered orders with neither a handover nor a delivery date."""
    neither = (F.col("order_delivered_customer_date").isNull()
               & F.col("order_delivered_carrier_date").isNull())
    return cleaning.unusable(orders, (F.col("order_status") == delivered) & neither, "order_id")


def dropped_orders(landed: Mapping[str, DataFrame]) -> DataFrame:
    """The unusable orders, written down: usually a handful, which Spark sees
    from the file's size and then broadcasts instead of moving the order lines."""
    return pinned(unusable_orders(landed["orders"]))


def clean(landed: Mapping[str, DataFrame], dropped: DataFrame | None = None) -> tables.Tables:
    """The nine typed tables from the nine landed ones.

    Delivered orders without any date go, with all that hangs on them; a
    missing delivery date is estimated from the handover; one review per order
    stays; categories are translated where a translation exists; repeated
    coordinate rows are removed. Everything else is a cast.

    ``dropped`` are the orders to leave out, if they have been worked out before.
    """
    once = tables.Tables({"dropped": lambda: dropped_orders(landed) if dropped is None else dropped})
    translation = "product_category_name_translation"

    def kept(table: str) -> DataFrame:
        return cleaning.drop_rows(landed[table], once["dropped"], "order_id")

    def customers() -> DataFrame:
        left = cleaning.drop_owners(landed["customers"], landed["orders"], once["dropped"], "order_id", "customer_id")
        return cleaning.typed_projection(left, "customers")

    def orders() -> DataFrame:
        return cleaning.impute_from(
            cleaning.typed_projection(kept("orders"), "orders"),
            "order_delivered_customer_date", "order_delivered_carrier_date",
            HANDOVER_TO_CUSTOMER, F.col("order_status") == DELIVERED)

    def order_reviews() -> DataFrame:
        # The choice is made on the landed text, whose fixed-width form sorts as time,
        # and before the drop: each order then brings one row to that join.
        latest = ordered.latest_per_key(landed["order_reviews"], ["order_id"], "review_answer_timestamp")
        return cleaning.typed_projection(cleaning.drop_rows(latest, once["dropped"], "order_id"), "order_reviews")

    def products() -> DataFrame:
        named = lookup_with_fallback(landed["products"], landed[translation],
                                     "product_category_name", "product_category_name_english")
        return cleaning.typed_projection(named, "products", MISSPELT_COLUMNS)

    return tables.Tables({
        "customers": customers,
        "geolocation": lambda: cleaning.dedupe_rows(cleaning.typed_projection(landed["geolocation"], "geolocation")),
        "sellers": lambda: cleaning.typed_projection(landed["sellers"], "sellers"),
        "product_category_translation":
            lambda: cleaning.typed_projection(landed[translation], "product_category_translation"),
        "products": products,
        "orders": orders,
        "order_items": lambda: cleaning.typed_projection(kept("order_items"), "order_items"),
        "payments": lambda: cleaning.typed_projection(kept("order_payments"), "payments"),
        "order_reviews": order_reviews,
    })


def landing_checks(expected: Expectations) -> list[quality.Check]:
    return quality.row_counts(expected.landed_rows)


def cleaning_checks(expected: Expectations) -> list[quality.Check]:
    """Did each cleaning rule do what it claims? ``landed_orders`` and
    ``dropped_orders`` stand for the landed orders and the unusable ones."""
    is_delivered = f"order_status = '{DELIVERED}'"
    no_date = "order_delivered_customer_date IS NULL"
    gone = [quality.Matches(table, "of_dropped_orders", "true", "order_id", "dropped_orders", "true", 0)
            for table in ("orders", "order_items", "payments", "order_reviews")]
    return [
        *gone,
        quality.Count("orders", "delivered_without_date", f"{is_delivered} AND {no_date}", 0),
        quality.Count("orders", "delivered_before_handover",
                      "order_delivered_customer_date < order_delivered_carrier_date",
                      expected.delivered_before_handover, at_most=True),
        quality.Matches("orders", "imputed_dates", is_delivered, "order_id", "landed_orders",
                        f"{no_date} AND order_delivered_carrier_date IS NOT NULL", expected.imputed_orders),
        quality.Count("orders", "still_undelivered", no_date, expected.undelivered_orders),
        quality.Count("products", "lost_category",
                      "product_category_name IS NOT NULL AND product_category_name_english IS NULL", 0),
        # Found by absence: a category may be the same word in both languages.
        quality.Reference("products", "product_category_name", "product_category_translation",
                          expected=expected.fallback_products),
        quality.HasChild("customers", "customer_id", "orders"),
        quality.NoColumnLike("lenght"),
    ]


def typed_checks(expected: Expectations) -> list[quality.Check]:
    return [*quality.row_counts(expected.typed_rows), *quality.not_nulls(), *quality.row_rules(),
            *quality.unique_keys(), *quality.references(), *cleaning_checks(expected)]


def typed_report(typed: Mapping[str, DataFrame], landed: Mapping[str, DataFrame],
                 checks: Sequence[quality.Check], dropped: DataFrame | None = None) -> DataFrame:
    """``checks`` over the typed tables, with the landed and dropped orders at hand."""
    stand_ins = tables.Tables({
        "landed_orders": lambda: landed["orders"],
        "dropped_orders": lambda: unusable_orders(landed["orders"]) if dropped is None else dropped})
    # Column names are a matter of the typed tables alone.
    names = [c for c in checks if isinstance(c, quality.NoColumnLike)]
    rest = [c for c in checks if not isinstance(c, quality.NoColumnLike)]
    reports = [quality.run_checks(scanned, found)
               for scanned, found in ((ChainMap(stand_ins, typed), rest), (typed, names)) if found]
    return reduce(DataFrame.unionByName, reports)


def build(landed: Mapping[str, DataFrame], root: str, expected: Expectations,
          checks: Sequence[quality.Check] | None = None) -> Mapping[str, DataFrame]:
    """Gate, clean, write, gate again, and only then publish under ``root``.

    Checks on rows are answered by the write itself; the others read what was written. ``checks`` replaces the second
    gate for data with other rules.
    """
    spark: SparkSession = landed["orders"].sparkSession
    quality.enforce(quality.run_checks(landed, landing_checks(expected)))
    rows, others = quality.on_rows(typed_checks(expected) if checks is None else checks)
    dropped = dropped_orders(landed)

    def gate(typed: tables.Tables) -> None:
        report = quality.observed_report(spark, rows, typed.metrics)
        quality.enforce(report.unionByName(typed_report(typed, landed, others, dropped)) if others else report)

    return tables.reload(spark, root, clean(landed, dropped), gate, quality.metrics(rows))


def published_report(spark: SparkSession, root: str, checks: Sequence[quality.Check]) -> DataFrame:
    """The report on rows of what is published, by the ``checks`` it was built with. Reads no table."""
    rows, _ = quality.on_rows(checks)
    return quality.observed_report(spark, rows, tables.read_published(spark, root, TABLES).metrics)


def land_once(spark: SparkSession, folder: str, pattern: str = "{table}.csv",
              files: dict[str, str] | None = None) -> tables.Tables:
    """The raw tables, each converted to Parquet when first used.

    Reports, gates and cleaning read them many times, a few columns at a time;
    text would be parsed whole every time.
    """
    raw = csv_files.land(spark, folder, pattern, files)

    def maker(name: str) -> Callable[[], DataFrame]:
        return lambda: pinned(raw[name])

    return tables.Tables({name: maker(name) for name in raw})


def build_from_csv(spark: SparkSession, folder: str, root: str, expected: Expectations | None = None,
                   pattern: str = "{table}.csv", files: dict[str, str] | None = None) -> Mapping[str, DataFrame]:
    """The whole job, from a folder of raw CSV files to published tables."""
    return build(land_once(spark, folder, pattern, files), root, expected or Expectations())
