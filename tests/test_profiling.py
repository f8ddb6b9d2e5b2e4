from decimal import Decimal as D

from pyspark.sql import functions as F

from stallbook.functions.casts import is_valid
from stallbook.operators import profiling
from stallbook.plans import profile


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_key_uniqueness(landed):
    found = rows(profiling.key_uniqueness(landed, [
        ("order_reviews", ["review_id"]), ("order_reviews", ["order_id"]),
        ("order_reviews", ["review_id", "order_id"]), ("customers", ["customer_unique_id"])]))
    assert found == [("customers.customer_unique_id", 11, 7), ("order_reviews (review_id, order_id)", 11, 11),
                     ("order_reviews.order_id", 11, 8), ("order_reviews.review_id", 11, 10)]


def test_composite_keys_count_nulls_and_single_keys_do_not(spark):
    t = {"t": spark.createDataFrame([(1, None), (1, None), (None, None), (2, 3)], "a int, b int")}
    assert rows(profiling.key_uniqueness(t, [("t", ["a"]), ("t", ["a", "b"])])) == [("t (a, b)", 4, 3), ("t.a", 4, 2)]


def test_cast_validity_of_text(spark):
    text = spark.createDataFrame([(v,) for v in ["12", " 12 ", "12.0", "", "99999999999", None, "2018",
                                                 "2018-01-01", "2018-01-01 10:00:00", "2018-13-01 10:00:00"]], "v string")
    def valid(kind):
        return [r["v"] for r in text.where(is_valid("v", kind)).collect()]
    assert valid("int") == ["12", " 12 ", "2018"]
    assert valid("decimal(10,2)") == ["12", " 12 ", "12.0", "2018"]
    assert valid("timestamp_ntz") == ["2018-01-01", "2018-01-01 10:00:00"]
    assert text.select(is_valid("v", "int").alias("ok")).where("ok IS NULL").count() == 1


def test_cast_validity_report(landed):
    found = rows(profiling.cast_validity(landed, [
        ("orders", "order_delivered_customer_date", "timestamp_ntz"), ("orders", "order_status", "int"),
        ("products", "product_weight_g", "int")]))
    assert found == [("orders.order_delivered_customer_date -> timestamp_ntz", 6, 0),
                     ("orders.order_status -> int", 11, 11), ("products.product_weight_g -> int", 7, 0)]


def test_missing_dates_by_status(landed):
    found = rows(profiling.missing_by(landed["orders"], "order_status", {
        "order_approved_at": "no_approved", "order_delivered_carrier_date": "no_carrier",
        "order_delivered_customer_date": "no_delivered"}))
    assert found == [("delivered", 8, 0, 1, 2), ("canceled", 1, 1, 1, 1), ("shipped", 1, 0, 0, 1),
                     ("unavailable", 1, 0, 1, 1)]


def test_group_sizes(landed):
    assert rows(profiling.group_sizes(landed["order_reviews"], "order_id")) == [(1, 6), (2, 1), (3, 1)]
    assert rows(profiling.group_sizes(landed["order_reviews"], "review_id")) == [(1, 9), (2, 1)]


def test_orphans_and_gaps(landed):
    relations = [("products", "product_category_name", "product_category_name_translation", "product_category_name"),
                 ("customers", "customer_zip_code_prefix", "geolocation", "geolocation_zip_code_prefix"),
                 ("order_items", "order_id", "orders", "order_id")]
    assert [n for _, n in rows(profiling.orphan_report(landed, relations))] == [2, 1, 0]
    assert rows(profiling.missing_lookups(landed["products"], "product_category_name",
                                          landed["product_category_name_translation"])) == [("pc_gamer", 1)]
    gaps = dict(rows(profiling.coverage_gaps(landed, [
        ("orders", "order_id", "order_items", "order_id"), ("orders", "order_id", "order_payments", "order_id"),
        ("products", "product_id", "order_items", "product_id")], [("products", "product_category_name")])))
    assert gaps == {"orders with no order_items": 1, "orders with no order_payments": 1,
                    "products with no order_items": 0, "products with NULL product_category_name": 1}
    assert rows(profiling.uncovered_keys(landed["sellers"], "seller_zip_code_prefix", landed["geolocation"],
                                         "geolocation_zip_code_prefix")) == [("88888",)]


def test_encoding(spark, landed):
    lookup = landed["product_category_name_translation"]
    assert rows(profiling.encoding_sample(lookup, "product_category_name")) == [("audio", "617564696f")]
    marked = spark.createDataFrame([("\ufeffa", "b"), ("c", None)], "x string, y string")
    assert rows(profiling.byte_order_marks(marked, ["x", "y"])) == [("x", 1), ("y", 0)]


def test_gap_statistics(typed):
    carried = typed["orders"].where("order_id <> 'o4'")
    stats = profiling.gap_statistics(carried, "order_delivered_carrier_date", "order_delivered_customer_date").first()
    # o1 17d4h, o2 18d13h, o3 18d16.5h, o5 25d10h, o10 6d10h, o11 20d10h: the middle two are o2 and o3.
    assert (stats["rows"], stats["negative"]) == (6, 0)
    assert stats["median_days"] == round((18 + 13 / 24 + 18 + 16.5 / 24) / 2, 4)
    assert stats["mean_days"] == round((17 + 4 / 24 + 18 + 13 / 24 + 18 + 16.5 / 24 + 25 + 10 / 24 + 6 + 10 / 24 + 20 + 10 / 24) / 6, 4)


def test_gap_statistics_of_nothing(typed):
    none = profiling.gap_statistics(typed["orders"].limit(0), "order_delivered_carrier_date", "order_delivered_customer_date")
    assert rows(none) == [(0, None, None, 0)]


def test_conflicting_duplicates(landed):
    reviews = landed["order_reviews"].withColumn("review_score", F.col("review_score").cast("int"))
    assert rows(profiling.conflicting_duplicates(reviews, "order_id", "review_score")) == [
        ("conflicting", 1, D("4.00"), 4), ("identical", 1, D("0.00"), 0)]


def test_attribute_multiplicity(landed):
    found = profiling.attribute_multiplicity(landed["customers"], "customer_unique_id",
                                             ["customer_zip_code_prefix", "customer_state"])
    assert rows(found) == [(7, 1, 0, 3)]


def test_profile_runs_every_report(landed):
    reports = {name: df.collect() for name, df in profile.profile(landed).items()}
    assert len(reports) == 12 and all(reports.values())
    assert len(reports["cast_validity"]) == len(profile.casts()) == 27
    assert {r["bad"] for r in reports["cast_validity"]} == {0}
