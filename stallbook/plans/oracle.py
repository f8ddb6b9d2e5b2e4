"""The same answers in plain SQL over the same tables, for another engine.

Written from the meaning of each query and on its own: nothing here is derived
from the operators. Rounding is done on whole numbers, so it is exact.
"""

from __future__ import annotations

import re

# --- views of the star tables as the retail model --------------------------------

_VIEWS = {
    "translation_v": """
        SELECT * FROM (VALUES ('ECONOMY', 'economy'), ('LARGE', 'large'), ('MEDIUM', 'medium'), ('PROMO', 'PROMO'))
          AS t(product_category_name, product_category_name_english)""",
    "products_v": """
        SELECT p_partkey AS product_id, pt AS product_category_name,
               CASE pt WHEN 'ECONOMY' THEN 'economy' WHEN 'LARGE' THEN 'large' WHEN 'MEDIUM' THEN 'medium'
                       ELSE pt END AS english
        FROM (SELECT p_partkey, nullif(CASE p_brand WHEN 'Brand#25' THEN '' ELSE p_type END, '') AS pt FROM part)""",
    "items_v": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS seller_id,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS price
        FROM lineitem""",
    "arrived_v": """
        SELECT o_orderkey AS order_id, o_custkey, o_orderstatus, max(l_shipdate)::DATE AS arrived,
               o_orderdate::DATE + 30 AS promised,
               CAST(substr(o_orderpriority, 1, 1) AS INT) AS score
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey
        GROUP BY o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority""",
    "spend_v": """
        SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus,
               sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
        GROUP BY ALL""",
    "category_sales_v": """
        SELECT date_trunc('month', o_orderdate)::DATE AS month, coalesce(english, 'unknown') AS category,
               sum(price) AS revenue
        FROM items_v JOIN orders ON o_orderkey = order_id JOIN products_v USING (product_id)
        WHERE o_orderstatus <> 'P'
        GROUP BY ALL""",
    # landed tables
    "landed_orders": """
        SELECT o_orderkey, o_custkey,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END AS status,
               o_orderdate, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS approved,
               (SELECT min(l_shipdate) FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber <= 3) AS handover,
               (SELECT max(l_shipdate) FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag <> 'N') AS arrival,
               o_orderdate::DATE + 30 AS promised
        FROM orders""",
    "landed_reviews": """
        SELECT l_orderkey, l_partkey, least(l_linenumber, 5) AS score, l_linestatus, l_shipdate,
               l_shipdate + to_days(CAST(l_quantity AS INT)) AS answered
        FROM lineitem""",
    "dropped_v": """
        SELECT o_orderkey AS dropped FROM landed_orders
        WHERE status = 'delivered' AND handover IS NULL AND arrival IS NULL""",
    # typed tables
    "customers_c": """
        SELECT o_orderkey::VARCHAR AS customer_id, o_custkey::VARCHAR AS customer_unique_id,
               c_nationkey AS customer_zip_code_prefix, c_mktsegment AS customer_city,
               c_nationkey::VARCHAR AS customer_state
        FROM orders JOIN customer ON c_custkey = o_custkey
        WHERE o_orderkey NOT IN (SELECT dropped FROM dropped_v)""",
    "geolocation_c": """
        SELECT l_linenumber AS geolocation_zip_code_prefix, CAST(l_discount AS DECIMAL(9,2)) AS geolocation_lat,
               CAST(l_tax AS DECIMAL(9,2)) AS geolocation_lng,
               l_returnflag AS geolocation_city, l_linestatus AS geolocation_state
        FROM lineitem GROUP BY ALL""",
    "sellers_c": """
        SELECT s_suppkey::VARCHAR AS seller_id, s_nationkey AS seller_zip_code_prefix, s_name AS seller_city,
               s_nationkey::VARCHAR AS seller_state
        FROM supplier""",
    "product_category_translation_c": "SELECT * FROM translation_v",
    "products_c": """
        SELECT product_id::VARCHAR AS product_id, product_category_name, english AS product_category_name_english,
               length(p_name) AS product_name_length, length(p_brand) AS product_description_length,
               p_size AS product_photos_qty, p_size AS product_weight_g, p_size AS product_length_cm,
               p_size AS product_height_cm, p_size AS product_width_cm
        FROM products_v JOIN part ON p_partkey = product_id""",
    "orders_c": """
        SELECT o_orderkey::VARCHAR AS order_id, o_orderkey::VARCHAR AS customer_id, status AS order_status,
               o_orderdate AS order_purchase_timestamp, approved AS order_approved_at,
               handover AS order_delivered_carrier_date,
               CASE WHEN status = 'delivered' AND arrival IS NULL
                    THEN handover + INTERVAL 7 DAY + INTERVAL 144 MINUTE ELSE arrival END
                 AS order_delivered_customer_date,
               promised AS order_estimated_delivery_date
        FROM landed_orders WHERE o_orderkey NOT IN (SELECT dropped FROM dropped_v)""",
    "order_items_c": """
        SELECT l_orderkey::VARCHAR AS order_id, l_linenumber AS order_item_id, l_partkey::VARCHAR AS product_id,
               l_suppkey::VARCHAR AS seller_id, l_shipdate AS shipping_limit_date,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS price, CAST(l_tax AS DECIMAL(10,2)) AS freight_value
        FROM lineitem WHERE l_orderkey NOT IN (SELECT dropped FROM dropped_v)""",
    "payments_c": """
        SELECT l_orderkey::VARCHAR AS order_id, l_linenumber AS payment_sequential,
               CASE l_returnflag WHEN 'A' THEN 'boleto' WHEN 'N' THEN 'credit_card' ELSE 'voucher' END
                 AS payment_type,
               CAST(l_quantity AS INT) AS payment_installments,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS payment_value
        FROM lineitem WHERE l_orderkey NOT IN (SELECT dropped FROM dropped_v)""",
    "order_reviews_c": """
        SELECT l_orderkey::VARCHAR AS order_id, l_partkey::VARCHAR AS review_id, score AS review_score,
               CAST(NULL AS VARCHAR) AS review_comment_title, l_linestatus AS review_comment_message,
               l_shipdate AS review_creation_date, answered AS review_answer_timestamp
        FROM landed_reviews WHERE l_orderkey NOT IN (SELECT dropped FROM dropped_v)
        QUALIFY row_number() OVER (PARTITION BY l_orderkey
          ORDER BY answered DESC, l_partkey::VARCHAR DESC, score DESC, l_linestatus DESC, l_shipdate DESC) = 1""",
}

# The typed tables with the violations that ``star.planted`` puts in.
_PLANTED = {
    "orders": "CASE WHEN order_status = 'shipped' THEN order_purchase_timestamp - INTERVAL 1 DAY ELSE order_approved_at END "
              "AS order_approved_at, CASE order_status WHEN 'canceled' THEN 'lost' ELSE order_status END AS order_status, "
              "CASE order_status WHEN 'shipped' THEN 'x' || customer_id ELSE customer_id END AS customer_id",
    "order_items": "CASE order_item_id WHEN 2 THEN -price ELSE price END AS price, "
                   "CASE WHEN order_item_id <> 3 THEN product_id END AS product_id, "
                   "CASE order_item_id WHEN 4 THEN 'none' ELSE seller_id END AS seller_id, "
                   "CASE order_item_id WHEN 5 THEN 0 ELSE order_item_id END AS order_item_id",
    "payments": "CASE payment_sequential WHEN 2 THEN -payment_value ELSE payment_value END AS payment_value, "
                "CASE payment_sequential WHEN 3 THEN 'cash' ELSE payment_type END AS payment_type, "
                "CASE payment_sequential WHEN 4 THEN -1 ELSE payment_installments END AS payment_installments, "
                "CASE payment_sequential WHEN 5 THEN 'none' ELSE order_id END AS order_id",
    "order_reviews": "CASE review_score WHEN 5 THEN 9 ELSE review_score END AS review_score, "
                     "CASE WHEN review_score <> 2 THEN review_creation_date END AS review_creation_date, "
                     "CASE review_score WHEN 1 THEN review_creation_date - INTERVAL 1 DAY ELSE review_answer_timestamp END "
                     "AS review_answer_timestamp",
    "geolocation": "CASE geolocation_city WHEN 'A' THEN 91 ELSE geolocation_lat END AS geolocation_lat, "
                   "CASE WHEN geolocation_city <> 'N' THEN geolocation_city END AS geolocation_city",
    "sellers": "CASE WHEN seller_zip_code_prefix >= 5 THEN seller_city END AS seller_city",
}
_VIEWS |= {f"{table}_p": f"SELECT * REPLACE ({changes}) FROM {table}_c" for table, changes in _PLANTED.items()}


def _with_planted(body: str) -> str:
    return re.sub(rf"\b({'|'.join(_PLANTED)})_c\b", r"\1_p", body)


def crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, eight shifts a byte; the polynomial is fixed."""
    codes = f"[('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT FOR i IN range(strlen({text}))]"
    shift = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    step = f"list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z: {shift})"
    return f"xor(list_reduce({codes}, lambda crc, byte: {step}, 4294967295::BIGINT), 4294967295)"


def _sql(body: str) -> str:
    """``body`` with the views it uses, directly or through others, ahead of it."""
    used: dict[str, None] = {}

    def need(text: str) -> None:
        for name, view in _VIEWS.items():
            if name not in used and re.search(rf"\b{name}\b", text):
                need(view)
                used[name] = None

    need(body)
    if not used:
        return body
    views = "WITH " + ",\n".join(f"{name} AS ({_VIEWS[name]})" for name in used)
    own = body.lstrip()
    # A body with a WITH of its own goes on where the views end.
    return f"{views},\n{own[len('WITH'):]}" if own.startswith("WITH") else f"{views}\n{body}"


def _as(table: str, **types: str) -> str:
    """All of ``table``, with the named columns cast to types other engines print alike."""
    casts = [f"CAST({column} AS {name}) AS {column}" for name, columns in types.items() for column in columns.split()]
    return f"SELECT * REPLACE ({', '.join(casts)}) FROM {table}"


def _mean2(total: str, n: str) -> str:
    """``total / n`` rounded to two places, half up, both whole and positive."""
    return f"((200 * {total} + {n}) // (2 * {n})) / 100.0"


# --- checks ----------------------------------------------------------------------

def _check(kind: str, subject: str, actual: str, expected: str = "0", at_most: bool = False) -> str:
    wanted = f"'<= ' || {expected}" if at_most else f"CAST({expected} AS VARCHAR)"
    compare = "<=" if at_most else "="
    return (f'SELECT \'{kind}\' AS "check", \'{subject}\' AS subject, {wanted} AS expected, '
            f"a AS actual, a {compare} {expected} AS passed FROM (SELECT CAST(({actual}) AS BIGINT) AS a)")


def _all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _rows(table: str, where: str = "true") -> str:
    return f"SELECT count(*) FROM {table} WHERE {where}"


_STAR_OF = {"customers": "orders", "geolocation": "lineitem", "sellers": "supplier", "products": "part",
            "orders": "orders", "order_items": "lineitem", "payments": "lineitem", "order_payments": "lineitem",
            "order_reviews": "lineitem", "product_category_translation": "translation_v",
            "product_category_name_translation": "translation_v"}
_LANDED = ["customers", "geolocation", "orders", "order_items", "order_payments", "order_reviews", "products",
           "sellers", "product_category_name_translation"]
_TYPED = ["customers", "geolocation", "sellers", "product_category_translation", "products", "orders",
          "order_items", "payments", "order_reviews"]

_REQUIRED = {
    "customers": "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state",
    "geolocation": "geolocation_zip_code_prefix geolocation_lat geolocation_lng geolocation_city geolocation_state",
    "sellers": "seller_id seller_zip_code_prefix seller_city seller_state",
    "product_category_translation": "product_category_name product_category_name_english",
    "products": "product_id",
    "orders": "order_id customer_id order_status order_purchase_timestamp order_estimated_delivery_date",
    "order_items": "order_id order_item_id product_id seller_id shipping_limit_date price freight_value",
    "payments": "order_id payment_sequential payment_type payment_installments payment_value",
    "order_reviews": "order_id review_id review_score review_creation_date review_answer_timestamp",
}

_KEYS = [("customers", "customer_id"), ("sellers", "seller_id"), ("products", "product_id"),
         ("product_category_translation", "product_category_name"), ("orders", "order_id"),
         ("orders", "customer_id"), ("order_reviews", "order_id"), ("order_items", "order_id, order_item_id"),
         ("payments", "order_id, payment_sequential")]

# What a row looks like that breaks the rule.
_BROKEN = {
    "order_reviews.score_range": "review_score < 1 OR review_score > 5",
    "order_items.amounts_non_negative": "price < 0 OR freight_value < 0",
    "payments.value_non_negative": "payment_value < 0",
    "order_items.line_number_positive": "order_item_id < 1",
    "payments.sequence_positive": "payment_sequential < 1 OR payment_installments < 0",
    "geolocation.coordinates_possible": "abs(geolocation_lat) > 90 OR abs(geolocation_lng) > 180",
    "orders.approved_after_purchase": "order_approved_at < order_purchase_timestamp",
    "order_reviews.answered_after_creation": "review_answer_timestamp < review_creation_date",
    "orders.status_known": "order_status NOT IN ('approved', 'canceled', 'created', 'delivered', 'invoiced', "
                           "'processing', 'shipped', 'unavailable')",
    "payments.type_known": "payment_type NOT IN ('boleto', 'credit_card', 'debit_card', 'not_defined', 'voucher')",
}
_REPORTED = {
    "orders.carrier_after_purchase": "order_delivered_carrier_date < order_purchase_timestamp",
    "orders.delivered_after_carrier": "order_delivered_customer_date < order_delivered_carrier_date",
    "products.weight_positive": "product_weight_g <= 0",
    "geolocation.coordinates_in_box": "geolocation_lat > 0.05 OR geolocation_lng > 0.04",
}


def _repeated(table: str, key: str) -> str:
    return f"SELECT count(*) FROM (SELECT 1 FROM {table}_c GROUP BY {key} HAVING count(*) > 1)"


def _lost(child: str, key: str, parent: str, parent_key: str) -> str:
    return (f"SELECT count(*) FROM {child} x WHERE x.{key} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {parent} y WHERE y.{parent_key} = x.{key})")


def _rules(broken: dict[str, str]) -> list[str]:
    return [_check("rule", name, _rows(name.split(".")[0] + "_c", where)) for name, where in broken.items()]


_UNIQUE = [_check("unique_key", f"{t}({k})", _repeated(t, k)) for t, k in _KEYS]

_CLEANING = [
    *[_check("matches", f"{t}.of_dropped_orders",
             f"SELECT count(*) FROM {t}_c WHERE order_id IN (SELECT dropped::VARCHAR FROM dropped_v)")
      for t in ("orders", "order_items", "payments", "order_reviews")],
    _check("count", "orders.delivered_without_date",
           _rows("orders_c", "order_status = 'delivered' AND order_delivered_customer_date IS NULL")),
    _check("count", "orders.delivered_before_handover",
           _rows("orders_c", "order_delivered_customer_date < order_delivered_carrier_date"), at_most=True),
    _check("matches", "orders.imputed_dates",
           _rows("landed_orders", "status = 'delivered' AND arrival IS NULL AND handover IS NOT NULL")),
    _check("count", "orders.still_undelivered", _rows("orders_c", "order_delivered_customer_date IS NULL")),
    _check("count", "products.lost_category",
           _rows("products_c", "product_category_name IS NOT NULL AND product_category_name_english IS NULL")),
    _check("reference", "products.product_category_name -> product_category_translation",
           _lost("products_c", "product_category_name", "translation_v", "product_category_name")),
    _check("has_child", "customers.customer_id <- orders",
           _lost("customers_c", "customer_id", "orders_c", "customer_id")),
    _check("no_column_like", "lenght", "SELECT 0"),
]

# --- casts -----------------------------------------------------------------------

# The landed text of each typed column comes from a typed column of the given
# tables, so every value is valid; what varies is how many there are.
_CASTS = [
    ("customers", "customer_zip_code_prefix", "int", "orders JOIN customer ON c_custkey = o_custkey", "c_nationkey"),
    ("geolocation", "geolocation_zip_code_prefix", "int", "lineitem", "l_linenumber"),
    ("geolocation", "geolocation_lat", "decimal(38,18)", "lineitem", "l_discount"),
    ("geolocation", "geolocation_lng", "decimal(38,18)", "lineitem", "l_tax"),
    ("orders", "order_purchase_timestamp", "timestamp_ntz", "landed_orders", "o_orderdate"),
    ("orders", "order_approved_at", "timestamp_ntz", "landed_orders", "approved"),
    ("orders", "order_delivered_carrier_date", "timestamp_ntz", "landed_orders", "handover"),
    ("orders", "order_delivered_customer_date", "timestamp_ntz", "landed_orders", "arrival"),
    ("orders", "order_estimated_delivery_date", "date", "landed_orders", "promised"),
    ("order_items", "order_item_id", "int", "lineitem", "l_linenumber"),
    ("order_items", "shipping_limit_date", "timestamp_ntz", "lineitem", "l_shipdate"),
    ("order_items", "price", "decimal(10,2)", "lineitem", "l_extendedprice"),
    ("order_items", "freight_value", "decimal(10,2)", "lineitem", "l_tax"),
    ("order_payments", "payment_sequential", "int", "lineitem", "l_linenumber"),
    ("order_payments", "payment_installments", "int", "lineitem", "l_quantity"),
    ("order_payments", "payment_value", "decimal(10,2)", "lineitem", "l_extendedprice"),
    ("order_reviews", "review_score", "int", "lineitem", "l_linenumber"),
    ("order_reviews", "review_creation_date", "timestamp_ntz", "lineitem", "l_shipdate"),
    ("order_reviews", "review_answer_timestamp", "timestamp_ntz", "landed_reviews", "answered"),
    ("products", "product_photos_qty", "int", "part", "p_size"),
    ("products", "product_weight_g", "int", "part", "p_size"),
    ("products", "product_length_cm", "int", "part", "p_size"),
    ("products", "product_height_cm", "int", "part", "p_size"),
    ("products", "product_width_cm", "int", "part", "p_size"),
    ("sellers", "seller_zip_code_prefix", "int", "supplier", "s_nationkey"),
]


def _cast(table: str, column: str, type_name: str, source: str, value: str, bad: str = "0") -> str:
    return (f"SELECT '{table}.{column} -> {type_name}' AS col, count({value}) AS non_null, "
            f"CAST({bad} AS BIGINT) AS bad FROM {source}")


# --- all queries -------------------------------------------------------------------

def oracle_sql() -> dict[str, str]:
    childless = "SELECT o_orderkey AS order_id FROM orders"
    uncast = "count(*) FILTER (WHERE {0} IS NOT NULL AND try_cast({0} AS INTEGER) IS NULL)"
    json_number = "json_extract_string(props, '$.k')"
    candidates = [
        ("orders.order_id", "orders", "o_orderkey"), ("customers.customer_id", "orders", "o_orderkey"),
        ("customers.customer_unique_id", "orders", "o_custkey"), ("products.product_id", "part", "p_partkey"),
        ("sellers.seller_id", "supplier", "s_suppkey"), ("order_reviews.review_id", "lineitem", "l_partkey"),
        ("order_reviews.order_id", "lineitem", "l_orderkey"),
        ("order_reviews (review_id, order_id)", "lineitem", "(l_partkey, l_orderkey)"),
        ("order_items (order_id, order_item_id)", "lineitem", "(l_orderkey, l_linenumber)"),
        ("order_payments (order_id, payment_sequential)", "lineitem", "(l_orderkey, l_linenumber)"),
    ]
    relations = [
        ("orders.customer_id -> customers", "orders", "o_orderkey", "orders", "o_orderkey"),
        ("order_items.order_id -> orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("order_items.product_id -> products", "lineitem", "l_partkey", "part", "p_partkey"),
        ("order_items.seller_id -> sellers", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
        ("order_payments.order_id -> orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("order_reviews.order_id -> orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("products.product_category_name -> product_category_name_translation", "products_v",
         "product_category_name", "translation_v", "product_category_name"),
        ("customers.customer_zip_code_prefix -> geolocation",
         "(SELECT c_nationkey FROM orders JOIN customer ON c_custkey = o_custkey)", "c_nationkey",
         "lineitem", "l_linenumber"),
    ]
    components = ("SELECT doc_id, unnest(range(len(e))) AS position, "
                  "round(CAST(unnest(e) AS DOUBLE), 6) AS component FROM ({})")
    fresh = ("SELECT vec_id, list_transform(embedding, lambda x: CAST(round(CAST(x / 2 AS DOUBLE), 6) AS FLOAT)) AS e "
             "FROM embeddings WHERE vec_id IN (SELECT doc_id FROM labels)")
    seed = "(SELECT CAST(embedding AS DOUBLE[64]) FROM embeddings WHERE vec_id = 0)"
    nearest = ("SELECT vec_id, CAST(label AS BIGINT) AS label, "
               "round({0}(CAST(embedding AS DOUBLE[64]), " + seed + "), 6) AS distance "
               "FROM embeddings ORDER BY {0}(CAST(embedding AS DOUBLE[64]), " + seed + "), vec_id LIMIT 5")
    pending = ("SELECT doc_id, {0} FROM documents WHERE length(text) >= 20 "
               "AND doc_id NOT IN (SELECT vec_id FROM embeddings)")

    timing = f"""
        SELECT CASE WHEN late < -7 THEN 'a. 8+ days early' WHEN late < 0 THEN 'b. 1-7 days early'
                    WHEN late = 0 THEN 'c. on the estimated day' WHEN late <= 7 THEN 'd. 1-7 days late'
                    ELSE 'e. 8+ days late' END AS delivery_timing,
               count(*) AS orders, {_mean2('sum(score)', 'count(*)')} AS avg_review_score,
               ((2000 * count(*) FILTER (WHERE score = 1) + count(*)) // (2 * count(*))) / 10.0 AS pct_one_star
        FROM ({{}}) GROUP BY 1"""

    bodies = {
        # analytics
        "late_deliveries": """
            SELECT c_mktsegment AS customer_city, product_category_name
            FROM arrived_v JOIN lineitem ON l_orderkey = order_id
            JOIN customer ON c_custkey = o_custkey JOIN products_v ON product_id = l_partkey
            WHERE arrived > promised""",
        "unmatched_not_exists": childless + " WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
        "unmatched_not_in": childless + " WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
        "unmatched_left_null": childless + " LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE l_orderkey IS NULL",
        "unlabelled_documents": "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
        "never_ordered_products": "SELECT p_partkey AS product_id FROM part ANTI JOIN lineitem ON l_partkey = p_partkey",
        "monthly_revenue": """
            SELECT CAST(date_trunc('month', o_orderdate)::DATE AS VARCHAR) AS months,
                   CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
            FROM orders, lineitem WHERE o_orderkey = l_orderkey AND o_orderstatus IN ('F', 'O')
            GROUP BY 1""",
        "category_scores": f"""
            SELECT category, {_mean2('sum(score)', 'count(*)')} AS avg_score, count(*) AS reviews
            FROM (SELECT order_id, english AS category, any_value(CAST(o_orderpriority[1] AS INT)) AS score
                  FROM items_v JOIN products_v USING (product_id) JOIN orders ON o_orderkey = order_id
                  WHERE english IS NOT NULL GROUP BY 1, 2)
            GROUP BY category HAVING count(*) >= 20""",
        "seller_ranks": """
            WITH r AS (SELECT s_suppkey AS seller_id, s_nationkey::VARCHAR AS seller_state, sum(price) AS revenue
                       FROM supplier JOIN items_v ON seller_id = s_suppkey GROUP BY ALL)
            SELECT seller_id, seller_state, CAST(revenue AS DOUBLE) AS total_revenue,
                   1 + (SELECT count(*) FROM r b WHERE b.revenue > a.revenue) AS overall_rank,
                   1 + (SELECT count(*) FROM r b
                        WHERE b.revenue > a.revenue AND b.seller_state = a.seller_state) AS state_rank
            FROM r a""",
        "running_spend": """
            SELECT o_custkey AS customer_unique_id, CAST(o_orderdate AS VARCHAR) AS order_purchase_timestamp,
                   CAST(total AS DOUBLE) AS order_total,
                   CAST(sum(total) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)
                        AS DOUBLE) AS running_total
            FROM spend_v""",
        "top_products": """
            SELECT english AS category, product_id, count(*) AS sold_count
            FROM items_v JOIN products_v USING (product_id) WHERE english IS NOT NULL GROUP BY 1, 2
            QUALIFY row_number() OVER (PARTITION BY english ORDER BY count(*) DESC, product_id) <= 3""",
        "churned_customers": """
            WITH f AS (SELECT o_custkey AS customer, min(o_orderdate) AS first_ts FROM orders
                       JOIN customer ON c_custkey = o_custkey GROUP BY 1)
            SELECT customer, CAST(first_ts AS VARCHAR) AS first_ts FROM f
            WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = customer
                              AND o_orderdate > first_ts AND o_orderdate <= first_ts + INTERVAL 90 DAY)""",
        "top_categories": """
            SELECT category, CAST(sum(revenue) AS DOUBLE) AS revenue FROM category_sales_v
            GROUP BY category ORDER BY sum(revenue) DESC LIMIT 10""",
        "monthly_top_category": """
            SELECT CAST(month AS VARCHAR) AS month, category, CAST(revenue AS DOUBLE) AS revenue FROM category_sales_v
            QUALIFY revenue = max(revenue) OVER (PARTITION BY month)""",
        "cut_line_band": """
            WITH r AS (SELECT seller_id, sum(price) AS revenue FROM items_v JOIN orders ON o_orderkey = order_id
                       WHERE o_orderstatus <> 'P' GROUP BY 1),
                 k AS (SELECT *, rank() OVER (ORDER BY revenue DESC) AS n FROM r),
                 t AS (SELECT revenue AS tenth FROM r ORDER BY revenue DESC LIMIT 1 OFFSET 9),
                 g AS (SELECT k.*, tenth, tenth - revenue AS gap, CAST(abs(tenth - revenue) * 100 AS HUGEINT) AS cents,
                              CAST(tenth * 100 AS HUGEINT) AS whole FROM k, t)
            SELECT n AS revenue_rank, seller_id, s_nationkey::VARCHAR AS seller_state,
                   CAST(revenue AS DOUBLE) AS revenue, CAST(gap AS DOUBLE) AS gap_to_10th,
                   sign(gap) * ((2000 * cents + whole) // (2 * whole)) / 10.0 + 0.0 AS gap_pct
            FROM g JOIN supplier ON s_suppkey = seller_id WHERE n BETWEEN 8 AND 15""",
        "repeat_share": """
            WITH p AS (SELECT o_custkey, count(*) AS n, sum(total) AS spend FROM spend_v
                       WHERE o_orderstatus <> 'P' GROUP BY 1),
                 k AS (SELECT if(n = 1, 'one-time', 'repeat') AS customer_type, count(*) AS customers,
                              CAST(sum(n) AS BIGINT) AS num_orders, CAST(sum(spend) * 100 AS HUGEINT) AS cents
                       FROM p GROUP BY 1)
            SELECT customer_type, customers, num_orders,
                   ((20000 * customers + everyone) // (2 * everyone)) / 100.0 AS pct_of_customers,
                   ((2 * cents + num_orders) // (2 * num_orders)) / 100.0 AS avg_order_value
            FROM k, (SELECT CAST(count(*) AS BIGINT) AS everyone FROM p)""",
        "delay_vs_score": timing.format(
            "SELECT arrived - promised AS late, score FROM arrived_v WHERE o_orderstatus = 'F'"),
        "shipment_delay_vs_score": timing.format(
            "SELECT l_shipdate::DATE - (o_orderdate::DATE + 30) AS late, CAST(o_orderpriority[1] AS INT) AS score "
            "FROM (SELECT DISTINCT l_orderkey, l_shipdate FROM lineitem) JOIN orders ON o_orderkey = l_orderkey "
            "WHERE o_orderstatus = 'F'"),
        # vectors and embedding
        "nearest_cosine": nearest.format("array_cosine_distance"),
        "nearest_l2": nearest.format("array_distance"),
        "nearest_inner_product": nearest.format("array_negative_inner_product"),
        "pending_texts": pending.format("text") + " ORDER BY doc_id LIMIT 500",
        "embedded_texts": pending.format("CAST(1024 AS BIGINT) AS dimensions"),
        "vectors_updated": components.format(
            f"SELECT v.vec_id AS doc_id, coalesce(f.e, v.embedding) AS e FROM embeddings v LEFT JOIN ({fresh}) f "
            "USING (vec_id)"),
        "vectors_upserted": components.format(
            f"SELECT coalesce(f.id, v.vec_id) AS doc_id, coalesce(f.e, v.embedding) AS e FROM embeddings v "
            f"FULL JOIN (SELECT vec_id * 2 AS id, e FROM ({fresh})) f ON f.id = v.vec_id"),
        "embedded_count": "SELECT count(*) AS embedded FROM documents WHERE doc_id IN (SELECT vec_id FROM embeddings)",
        # cleaning
        "dropped_orders": "SELECT dropped::VARCHAR AS order_id FROM dropped_v",
        "clean_customers": _as("customers_c", BIGINT="customer_zip_code_prefix"),
        "clean_geolocation": _as("geolocation_c", BIGINT="geolocation_zip_code_prefix",
                                 DOUBLE="geolocation_lat geolocation_lng"),
        "clean_sellers": _as("sellers_c", BIGINT="seller_zip_code_prefix"),
        "clean_translation": """
            SELECT DISTINCT product_category_name, t.product_category_name_english
            FROM products_c p LEFT JOIN translation_v t USING (product_category_name)""",
        "clean_products": _as("products_c", BIGINT="product_name_length product_description_length "
                              "product_photos_qty product_weight_g product_length_cm product_height_cm "
                              "product_width_cm"),
        "clean_orders": _as("orders_c", VARCHAR="order_purchase_timestamp order_approved_at "
                            "order_delivered_carrier_date order_delivered_customer_date "
                            "order_estimated_delivery_date"),
        "clean_order_items": _as("order_items_c", BIGINT="order_item_id", VARCHAR="shipping_limit_date",
                                 DOUBLE="price freight_value"),
        "clean_payments": _as("payments_c", BIGINT="payment_sequential payment_installments", DOUBLE="payment_value"),
        "clean_order_reviews": _as("order_reviews_c", BIGINT="review_score",
                                   VARCHAR="review_creation_date review_answer_timestamp"),
        "latest_line_per_order": """
            SELECT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate, CAST(l_linenumber AS BIGINT) AS l_linenumber)
            FROM lineitem
            QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_partkey DESC,
              l_suppkey DESC, l_linenumber DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
              l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1""",
        # quality
        "landed_row_counts": _all([_check("row_count", t, _rows(_STAR_OF[t]), f"({_rows(_STAR_OF[t])})")
                                   for t in _LANDED]),
        "typed_row_counts": _all([_check("row_count", t, _rows(t + "_c"), f"({_rows(_STAR_OF[t])})") for t in _TYPED]),
        "unique_key_report": _all(_UNIQUE),
        "reference_report": _all([
            _check("reference", f"{c}.{k} -> {p}", _lost(c + "_c", k, p + "_c", k)) for c, k, p in [
                ("orders", "customer_id", "customers"), ("order_items", "order_id", "orders"),
                ("order_items", "product_id", "products"), ("order_items", "seller_id", "sellers"),
                ("payments", "order_id", "orders"), ("order_reviews", "order_id", "orders")]]),
        "dropped_reference_report": _all([
            _check("reference", f"landed_{t}.{k} -> orders",
                   f"SELECT count(*) FROM {_STAR_OF[t]} WHERE {c} IN (SELECT dropped FROM dropped_v)")
            for t, k, c in [("order_items", "order_id", "l_orderkey"), ("order_payments", "order_id", "l_orderkey"),
                            ("order_reviews", "order_id", "l_orderkey"), ("customers", "customer_id", "o_orderkey")]]),
        "row_rule_report": _all(_rules(_BROKEN)),
        "reported_rule_counts": 'SELECT * REPLACE (\'any\' AS expected, true AS passed) FROM (\n'
                                + _all(_rules(_REPORTED)) + ")",
        "not_null_report": _all([_check("not_null", f"{t}.{c}", _rows(t + "_c", f"{c} IS NULL"))
                                 for t, columns in _REQUIRED.items() for c in columns.split()]),
        "cleaning_report": _all(_CLEANING),
        "failed_checks": 'SELECT "check" || \' \' || rpad(subject, CAST(greatest(48, length(subject)) AS INT), \' \') '
                         "|| ' expected ' || expected || ', got ' || actual AS line FROM (\n"
                         + _all(_UNIQUE + _rules(_BROKEN)) + ") WHERE NOT passed",
        "published_row_counts": _all([f"SELECT '{t}' AS subject, count(*) AS actual FROM {t}_c" for t in _TYPED]),
        "published_orphan_products": """
            SELECT product_id FROM products_c WHERE product_id NOT IN (SELECT product_id FROM order_items_c)""",
        # profiling
        "key_uniqueness": _all([f"SELECT '{label}' AS candidate_key, count(*) AS rows, "
                                f"count(DISTINCT {key}) AS distinct_vals FROM {table}"
                                for label, table, key in candidates]),
        "cast_validity": _all([
            *[_cast(*c) for c in _CASTS],
            _cast("products", "product_name_lenght", "int", "part", "p_name"),
            _cast("products", "product_description_lenght", "int", "part", "p_brand"),
            _cast("events", "k", "int", "events", json_number, uncast.format(json_number)),
            _cast("part", "p_name", "int", "part", "p_name", uncast.format("p_name")),
        ]),
        "missing_dates_by_status": """
            SELECT status AS order_status, count(*) AS rows, count(*) - count(approved) AS no_approved,
                   count(*) - count(handover) AS no_carrier, count(*) - count(arrival) AS no_delivered
            FROM landed_orders GROUP BY 1""",
        "reviews_per_order": """
            SELECT n AS reviews_per_order, count(*) AS how_many_orders
            FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey) GROUP BY 1""",
        "rows_per_review_id": """
            SELECT n AS rows_per_review_id, count(*) AS how_many_review_ids
            FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_partkey) GROUP BY 1""",
        "orphan_report": _all([f"SELECT '{label}' AS relation, ({_lost(c, k, p, pk)}) AS orphan_rows"
                               for label, c, k, p, pk in relations]),
        "missing_translations": """
            SELECT product_category_name, count(*) AS rows FROM products_v
            WHERE product_category_name NOT IN (SELECT product_category_name FROM translation_v) GROUP BY 1""",
        "coverage_gaps": _all([
            *[f"SELECT 'orders with no {t}' AS gap, "
              f"({_lost('orders', 'o_orderkey', 'lineitem', 'l_orderkey')}) AS rows"
              for t in ("order_items", "order_reviews", "order_payments")],
            f"SELECT 'products with no order_items', ({_lost('part', 'p_partkey', 'lineitem', 'l_partkey')})",
            "SELECT 'products with NULL product_category_name', count(*) FROM part WHERE p_brand = 'Brand#25'"]),
        "encoding_sample": """
            SELECT min(text) AS text, lower(hex(encode(min(text)))) AS hex FROM documents""",
        "byte_order_marks": _all([f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE starts_with({c}, chr(65279))) "
                                  "AS marked FROM documents" for c in ("text", "lang", "source")]),
        "uncovered_zips": """
            SELECT DISTINCT c_nationkey::VARCHAR AS customer_zip_code_prefix
            FROM customer SEMI JOIN orders ON o_custkey = c_custkey
            WHERE c_nationkey NOT IN (SELECT l_linenumber FROM lineitem)""",
        "customer_coordinates": """
            SELECT customer_id, round(lat, 6) AS lat, round(lng, 6) AS lng, points FROM customers_c LEFT JOIN
              (SELECT geolocation_zip_code_prefix AS z, avg(geolocation_lat) AS lat, avg(geolocation_lng) AS lng,
                      count(*) AS points FROM geolocation_c GROUP BY 1) ON z = customer_zip_code_prefix""",
        "handover_gaps": """
            SELECT count(*) AS rows, round(median(s) / 86400.0, 4) AS median_days,
                   round(avg(s) / 86400.0, 4) AS mean_days, count(*) FILTER (WHERE s < 0) AS negative
            FROM (SELECT date_diff('second', o_orderdate, l_shipdate) AS s
                  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)""",
        "conflicting_reviews": f"""
            SELECT if(gap > 0, 'conflicting', 'identical') AS scores, count(*) AS keys,
                   {_mean2('sum(gap)', 'count(*)')} AS mean_gap, CAST(max(gap) AS BIGINT) AS worst_gap
            FROM (SELECT max(score) - min(score) AS gap FROM landed_reviews GROUP BY l_orderkey HAVING count(*) > 1)
            GROUP BY 1""",
        "person_attributes": """
            SELECT count(*) AS persons, count(*) FILTER (WHERE s > 1) AS several_o_orderstatus,
                   count(*) FILTER (WHERE p > 1) AS several_o_orderpriority, max(n) AS most_rows
            FROM (SELECT count(DISTINCT o_orderstatus) AS s, count(DISTINCT o_orderpriority) AS p, count(*) AS n
                  FROM orders GROUP BY o_custkey)""",
        # sources and sinks
        "csv_landing": "SELECT doc_id::VARCHAR AS doc_id, text, lang, source FROM documents",
        "json_rows": "SELECT CAST(to_json(customer) AS VARCHAR) AS json FROM customer",
        "json_array": """
            SELECT CAST(to_json(list(nation ORDER BY n_nationkey)) AS VARCHAR) AS json FROM nation
            WHERE n_regionkey = 1""",
    }
    bodies["churned_by_antijoin"] = bodies["churned_customers"]
    for metric, function in (("cosine", "array_cosine_distance"), ("l2", "array_distance"),
                             ("inner_product", "array_negative_inner_product")):
        bodies[f"nearest_{metric}_indexed"] = bodies[f"nearest_{metric}"]
        apart = f"{function}(CAST(v.embedding AS DOUBLE[64]), CAST(s.embedding AS DOUBLE[64]))"
        bodies[f"nearest_to_each_{metric}"] = f"""
            SELECT s.vec_id AS seed, v.vec_id, round({apart}, 6) AS distance,
                   row_number() OVER (PARTITION BY s.vec_id ORDER BY {apart}, v.vec_id) AS position
            FROM embeddings s, embeddings v WHERE s.vec_id % 50 = 0 QUALIFY position <= 5"""
    for kind, report in (("rules", "row_rule_report"), ("not_nulls", "not_null_report"), ("references", "reference_report")):
        bodies[f"violated_{kind}"] = _with_planted(bodies[report])
    bodies["products_without_small_orders"] = """
        SELECT p_partkey AS product_id FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity <= 3)"""
    bodies["versions_with_added_column"] = """
        SELECT CAST(v AS BIGINT) AS version, order_id, CASE WHEN v = 2 AND review_score = 4 THEN 4.0::DOUBLE END AS first_component,
               'sentence embedding of the review message; NULL means not embedded yet' AS comment
        FROM order_reviews_c, range(1, 3) versions(v)"""
    # Of the given tables alone, whatever else the database holds.
    bodies["catalog_columns_like"] = """
        SELECT table_name AS "table", column_name AS "column" FROM information_schema.columns
        JOIN (SELECT unnest([{0}]) AS given) ON table_name = given
        JOIN (VALUES ('l!_%key', '!'), ('_ag_', '!'), ('%nation_ey%', '!')) AS p(pattern, sign)
          ON column_name LIKE pattern ESCAPE '!'""".format(", ".join(f"'{t}'" for t in (
        "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
        "conversations").split()))
    bodies["key_uniqueness_by_sketches"] = f"SELECT *, true AS estimate_is_near FROM ({bodies['key_uniqueness']})"
    bodies["handover_gaps_by_sketches"] = (
        f"SELECT rows, mean_days, negative, true AS median_is_near FROM ({bodies['handover_gaps']})")
    bodies["planted_byte_order_marks"] = """
        SELECT 'text' AS "column", count(*) FILTER (doc_id % 10 = 0 AND text IS NOT NULL) AS marked FROM documents
        UNION ALL SELECT 'lang', count(*) FILTER (doc_id % 7 = 0 AND lang IS NOT NULL) FROM documents
        UNION ALL SELECT 'source', 0"""
    bodies["embedded_vectors"] = f"""
        WITH tokens AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\pL\\pN_]+')) AS token
                        FROM ({pending.format("text")})),
             hashes AS (SELECT token, {crc32("token")} AS h FROM (SELECT DISTINCT token FROM tokens)),
             sums AS (SELECT doc_id, (h >> 1) % 1024 AS position, sum(CASE WHEN h & 1 = 1 THEN 1 ELSE -1 END)::DOUBLE AS n
                      FROM tokens JOIN hashes USING (token) GROUP BY ALL),
             lengths AS (SELECT doc_id, sqrt(sum(n * n)) AS length FROM sums GROUP BY doc_id)
        SELECT doc_id, position::BIGINT AS position, round(round(n / length, 6)::FLOAT::DOUBLE, 6) AS component
        FROM sums JOIN lengths USING (doc_id) WHERE n <> 0"""
    bodies["dropped_references_by_bitmap"] = bodies["dropped_reference_report"]
    bodies["vectors_written_back"] = bodies["vectors_upserted"]
    bodies["vectors_replaced"] = components.format(
        f"SELECT v.vec_id AS doc_id, coalesce(f.e, v.embedding) AS e FROM embeddings v "
        f"LEFT JOIN (SELECT vec_id * 2 AS id, e FROM ({fresh})) f ON f.id = v.vec_id")
    bodies["published_checks"] = "\nUNION ALL\n".join(
        f"SELECT * FROM ({bodies[name]})" for name in ("not_null_report", "row_rule_report", "reported_rule_counts"))
    return {name: _sql(body) for name, body in bodies.items()}
