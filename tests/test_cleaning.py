from datetime import date, datetime
from decimal import Decimal

import pytest

import shop
from stallbook import schemas
from stallbook.operators import analytics, cleaning, matching, ordered
from stallbook.plans import retail


def rows(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def test_row_counts_and_types(typed):
    assert {name: df.count() for name, df in typed.items()} == shop.TYPED_ROWS
    for name, df in typed.items():
        wanted = {c.name: c.type for c in schemas.typed_columns(name)}
        assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == wanted
    embedding = schemas.typed_schema("order_reviews")["embedding"]
    assert embedding.nullable and "not embedded yet" in embedding.metadata["comment"]


def test_dateless_delivered_order_goes_with_all_it_has(typed):
    for table in ("orders", "order_items", "payments", "order_reviews"):
        assert typed[table].where("order_id = 'o6'").count() == 0
    assert typed["customers"].where("customer_id = 'c6'").count() == 0
    assert rows(analytics.never_ordered(typed["products"], typed["order_items"]), "product_id") == {("p6",)}


def test_only_handed_over_delivered_orders_get_a_date(typed, landed):
    dates = dict(rows(typed["orders"], "order_id", "order_delivered_customer_date"))
    assert dates["o4"] == datetime(2018, 2, 10, 2, 24)
    assert [dates[o] for o in ("o7", "o8", "o9")] == [None, None, None]
    untouched = dict(rows(landed["orders"], "order_id", "order_delivered_customer_date"))
    assert all(str(dates[o]) == untouched[o] for o in ("o1", "o2", "o3", "o5", "o10", "o11"))


def test_latest_review_of_each_order_stays(typed):
    kept = rows(typed["order_reviews"], "order_id", "review_id")
    assert kept == {("o1", "r2"), ("o2", "r3"), ("o3", "r5"), ("o4", "r7"), ("o5", "r7"),
                    ("o8", "r9"), ("o10", "r10")}


def test_categories_fall_back_to_the_source_name(typed):
    names = dict(rows(typed["products"], "product_id", "product_category_name_english"))
    assert names == {"p1": "beauty", "p2": "audio", "p3": "pc_gamer", "p4": "beauty", "p5": None,
                     "p6": "audio", "p7": "beauty"}


def test_only_whole_copies_of_coordinates_go(typed):
    assert typed["geolocation"].where("geolocation_zip_code_prefix = 1001").count() == 2
    lat = typed["geolocation"].where("geolocation_zip_code_prefix = 20000").first()["geolocation_lat"]
    assert lat == Decimal("-22.912345678901234")


def test_typed_values(typed):
    item = typed["order_items"].where("order_id = 'o5'").first()
    assert (item["price"], item["order_item_id"]) == (Decimal("99.99"), 1)
    order = typed["orders"].where("order_id = 'o1'").first()
    assert order["order_estimated_delivery_date"] == date(2018, 1, 20)
    assert typed["customers"].where("customer_id = 'c1'").first()["customer_zip_code_prefix"] == 1001


def test_drop_with_dependents_in_one_go(landed):
    dropped = retail.unusable_orders(landed["orders"])
    left = cleaning.drop_with_dependents(landed["orders"], dropped, "order_id",
                                         {"order_items": landed["order_items"]}, landed["customers"], "customer_id")
    assert {name: df.count() for name, df in left.items()} == {"parents": 10, "owners": 10, "order_items": 12}


SELLERS = "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string"


@pytest.mark.parametrize("ansi,message", [("true", "CAST_INVALID_INPUT"), ("false", "seller_zip_code_prefix is no int: 12a")])
def test_bad_value_fails_the_cast(spark, ansi, message):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        good = spark.createDataFrame([("s", "012", "x", "y"), ("t", None, "x", "y")], SELLERS)
        assert rows(cleaning.typed_projection(good, "sellers"), "seller_zip_code_prefix") == {(12,), (None,)}
        bad = spark.createDataFrame([("s", "12a", "x", "y")], SELLERS)
        with pytest.raises(Exception, match=message):
            cleaning.typed_projection(bad, "sellers").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_latest_per_key_takes_null_as_latest_and_breaks_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", None, "y"), ("b", 2, "x"), ("b", 2, "z")], "k string, t int, v string")
    assert rows(ordered.latest_per_key(df, ["k"], "t"), "k", "v") == {("a", "y"), ("b", "z")}


def test_with_coordinates_multiplies_no_rows(typed):
    located = matching.with_coordinates(typed["customers"], "customer_zip_code_prefix", typed["geolocation"])
    by_id = {r["customer_id"]: r for r in located.collect()}
    assert len(by_id) == located.count() == 10
    assert float(by_id["c1"]["geolocation_lat"]) == pytest.approx(-23.6) and by_id["c1"]["points"] == 2
    assert by_id["c8"]["geolocation_lat"] is None
