"""The reports taken on the landed tables before cleaning."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from stallbook import schemas
from stallbook.operators import profiling
from stallbook.plans.retail import MISSPELT_COLUMNS
from stallbook.sources.tables import Tables

# --- fixed values ------------------------------------------------------------
CANDIDATE_KEYS = [
    ("orders", ["order_id"]), ("customers", ["customer_id"]), ("customers", ["customer_unique_id"]),
    ("products", ["product_id"]), ("sellers", ["seller_id"]), ("order_reviews", ["review_id"]),
    ("order_reviews", ["order_id"]), ("order_reviews", ["review_id", "order_id"]),
    ("order_items", ["order_id", "order_item_id"]), ("order_payments", ["order_id", "payment_sequential"]),
]
RELATIONS = [
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "seller_id", "sellers", "seller_id"),
    ("order_payments", "order_id", "orders", "order_id"),
    ("order_reviews", "order_id", "orders", "order_id"),
    ("products", "product_category_name", "product_category_name_translation", "product_category_name"),
]
CHILDREN = [
    ("orders", "order_id", "order_items", "order_id"), ("orders", "order_id", "order_reviews", "order_id"),
    ("orders", "order_id", "order_payments", "order_id"), ("products", "product_id", "order_items", "product_id"),
]
NULLABLE = [("products", "product_category_name")]
STATUS_DATES = {"order_approved_at": "no_approved", "order_delivered_carrier_date": "no_carrier",
                "order_delivered_customer_date": "no_delivered"}

_TYPED_NAMES = {"order_payments": "payments", "product_category_name_translation": "product_category_translation"}


def casts() -> list[tuple[str, str, str]]:
    """Every landed column that cleaning casts, with its type."""
    return [(table, MISSPELT_COLUMNS.get(column.name, column.name), column.type)
            for table in schemas.LANDING_COLUMNS
            for column in schemas.typed_columns(_TYPED_NAMES.get(table, table))
            if column.type != "string" and column.name != "embedding"]


def profile(landed: Mapping[str, DataFrame]) -> Tables:
    """All reports by name; each runs when it is asked for."""
    reviews = "order_reviews"
    return Tables({
        "key_uniqueness": lambda: profiling.key_uniqueness(landed, CANDIDATE_KEYS),
        "cast_validity": lambda: profiling.cast_validity(landed, casts()),
        "missing_dates_by_status": lambda: profiling.missing_by(landed["orders"], "order_status", STATUS_DATES),
        "reviews_per_order": lambda: profiling.group_sizes(
            landed[reviews], "order_id", "reviews_per_order", "how_many_orders"),
        "rows_per_review_id": lambda: profiling.group_sizes(
            landed[reviews], "review_id", "rows_per_review_id", "how_many_review_ids"),
        "orphans": lambda: profiling.orphan_report(landed, RELATIONS),
        "missing_translations": lambda: profiling.missing_lookups(
            landed["products"], "product_category_name", landed["product_category_name_translation"]),
        "coverage_gaps": lambda: profiling.coverage_gaps(landed, CHILDREN, NULLABLE),
        "encoding": lambda: profiling.encoding_sample(
            landed["product_category_name_translation"], "product_category_name"),
        "uncovered_customer_zips": lambda: profiling.uncovered_keys(
            landed["customers"], "customer_zip_code_prefix", landed["geolocation"], "geolocation_zip_code_prefix"),
        "uncovered_seller_zips": lambda: profiling.uncovered_keys(
            landed["sellers"], "seller_zip_code_prefix", landed["geolocation"], "geolocation_zip_code_prefix"),
        "person_addresses": lambda: profiling.attribute_multiplicity(
            landed["customers"], "customer_unique_id",
            ["customer_zip_code_prefix", "customer_city", "customer_state"]),
    })
