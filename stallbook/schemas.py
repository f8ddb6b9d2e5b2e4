"""The retail model as data: landing columns, typed columns, keys and rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: the source files' columns, in file order ------------------
# Two columns are misspelt in the source; the typed tables correct them.
LANDING_COLUMNS = {
    "customers": "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state",
    "geolocation": "geolocation_zip_code_prefix geolocation_lat geolocation_lng geolocation_city geolocation_state",
    "orders": "order_id customer_id order_status order_purchase_timestamp order_approved_at "
              "order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date",
    "order_items": "order_id order_item_id product_id seller_id shipping_limit_date price freight_value",
    "order_payments": "order_id payment_sequential payment_type payment_installments payment_value",
    "order_reviews": "review_id order_id review_score review_comment_title review_comment_message "
                     "review_creation_date review_answer_timestamp",
    "products": "product_id product_category_name product_name_lenght product_description_lenght "
                "product_photos_qty product_weight_g product_length_cm product_height_cm product_width_cm",
    "sellers": "seller_id seller_zip_code_prefix seller_city seller_state",
    "product_category_name_translation": "product_category_name product_category_name_english",
}

# --- fixed values: typed columns ---------------------------------------------
TYPED_COLUMNS = {
    "customers": """
        customer_id string NOT NULL, customer_unique_id string NOT NULL, customer_zip_code_prefix int NOT NULL,
        customer_city string NOT NULL, customer_state string NOT NULL""",
    "geolocation": """
        geolocation_zip_code_prefix int NOT NULL, geolocation_lat decimal(38,18) NOT NULL,
        geolocation_lng decimal(38,18) NOT NULL, geolocation_city string NOT NULL, geolocation_state string NOT NULL""",
    "sellers": """
        seller_id string NOT NULL, seller_zip_code_prefix int NOT NULL, seller_city string NOT NULL, seller_state string NOT NULL""",
    "product_category_translation": """
        product_category_name string NOT NULL, product_category_name_english string NOT NULL""",
    "products": """
        product_id string NOT NULL, product_category_name string, product_category_name_english string,
        product_name_length int, product_description_length int, product_photos_qty int,
        product_weight_g int, product_length_cm int, product_height_cm int, product_width_cm int""",
    "orders": """
        order_id string NOT NULL, customer_id string NOT NULL, order_status string NOT NULL,
        order_purchase_timestamp timestamp_ntz NOT NULL, order_approved_at timestamp_ntz,
        order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz,
        order_estimated_delivery_date date NOT NULL""",
    "order_items": """
        order_id string NOT NULL, order_item_id int NOT NULL, product_id string NOT NULL, seller_id string NOT NULL,
        shipping_limit_date timestamp_ntz NOT NULL, price decimal(10,2) NOT NULL, freight_value decimal(10,2) NOT NULL""",
    "payments": """
        order_id string NOT NULL, payment_sequential int NOT NULL, payment_type string NOT NULL,
        payment_installments int NOT NULL, payment_value decimal(10,2) NOT NULL""",
    "order_reviews": """
        order_id string NOT NULL, review_id string NOT NULL, review_score int NOT NULL, review_comment_title string,
        review_comment_message string, review_creation_date timestamp_ntz NOT NULL,
        review_answer_timestamp timestamp_ntz NOT NULL, embedding array<float>""",
}

# --- fixed values: keys, references and rules --------------------------------
UNIQUE_KEYS = [
    ("customers", ["customer_id"]),
    ("sellers", ["seller_id"]),
    ("products", ["product_id"]),
    ("product_category_translation", ["product_category_name"]),
    ("orders", ["order_id"]),
    ("orders", ["customer_id"]),
    ("order_reviews", ["order_id"]),
    ("order_items", ["order_id", "order_item_id"]),
    ("payments", ["order_id", "payment_sequential"]),
]

REFERENCES = [
    ("orders", "customer_id", "customers"),
    ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"),
    ("order_items", "seller_id", "sellers"),
    ("payments", "order_id", "orders"),
    ("order_reviews", "order_id", "orders"),
]

ORDER_STATUSES = ["approved", "canceled", "created", "delivered",
                  "invoiced", "processing", "shipped", "unavailable"]
PAYMENT_TYPES = ["boleto", "credit_card", "debit_card", "not_defined", "voucher"]


def _quoted(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


ROW_RULES = [
    ("order_reviews", "score_range", "review_score BETWEEN 1 AND 5"),
    ("order_items", "amounts_non_negative", "price >= 0 AND freight_value >= 0"),
    ("payments", "value_non_negative", "payment_value >= 0"),
    ("order_items", "line_number_positive", "order_item_id >= 1"),
    ("payments", "sequence_positive", "payment_sequential >= 1 AND payment_installments >= 0"),
    ("geolocation", "coordinates_possible",
     "geolocation_lat BETWEEN -90 AND 90 AND geolocation_lng BETWEEN -180 AND 180"),
    ("orders", "approved_after_purchase", "order_approved_at >= order_purchase_timestamp"),
    ("order_reviews", "answered_after_creation", "review_answer_timestamp >= review_creation_date"),
    ("orders", "status_known", f"order_status IN ({_quoted(ORDER_STATUSES)})"),
    ("payments", "type_known", f"payment_type IN ({_quoted(PAYMENT_TYPES)})"),
]

# Plausible rules real data breaks: counted for the report, never enforced.
# The box is a country's outline and so a parameter of ``coordinate_box``.
REPORT_ONLY_RULES = [
    ("orders", "carrier_after_purchase", "order_delivered_carrier_date >= order_purchase_timestamp"),
    ("orders", "delivered_after_carrier", "order_delivered_customer_date >= order_delivered_carrier_date"),
    ("products", "weight_positive", "product_weight_g > 0"),
]


def coordinate_box(south: float, north: float, west: float, east: float) -> tuple[str, str, str]:
    return ("geolocation", "coordinates_in_box",
            f"geolocation_lat BETWEEN {south} AND {north} AND geolocation_lng BETWEEN {west} AND {east}")


COMMENTS = {"embedding": "sentence embedding of the review message; NULL means not embedded yet"}


@dataclass(frozen=True)
class TypedColumn:
    name: str
    type: str
    required: bool

    @property
    def metadata(self) -> dict[str, str]:
        return {"comment": COMMENTS[self.name]} if self.name in COMMENTS else {}


def typed_columns(table: str) -> list[TypedColumn]:
    columns = []
    # commas inside a type, as in decimal(10,2), do not follow a space
    for entry in " ".join(TYPED_COLUMNS[table].split()).split(", "):
        name, type_name = entry.split(" ", 1)
        columns.append(TypedColumn(name, type_name.removesuffix(" NOT NULL"), type_name.endswith(" NOT NULL")))
    return columns


def landing_schema(table: str) -> T.StructType:
    """Every column a nullable string, in file order."""
    return T.StructType([T.StructField(c, T.StringType()) for c in LANDING_COLUMNS[table].split()])


def typed_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c.name, T.DataType.fromDDL(c.type), not c.required, c.metadata)
                         for c in typed_columns(table)])


def required_columns(table: str) -> list[str]:
    return [c.name for c in typed_columns(table) if c.required]
