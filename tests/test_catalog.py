import pytest

from stallbook import schemas
from stallbook.sources import catalog, tables


def test_columns_like_takes_wildcards_and_escapes(spark, tmp_path):
    spark.range(1).selectExpr("id AS a_key", "id AS abkey", "id AS `50%`", "id AS name_lenght").write.parquet(str(tmp_path / "t"))
    catalog.register(spark, "shop_catalog", {"t": str(tmp_path / "t")}, str(tmp_path / "db"))
    try:
        def names(pattern, escape="\\"):
            found = {r["column"] for r in catalog.columns_like(spark, "shop_catalog", pattern, escape).collect()}
            df = tables.read_tables(spark, str(tmp_path), ["t"], suffix="")
            assert {c for _, c in tables.columns_like(df, pattern, escape)} == found
            return found

        assert names("%lenght%") == {"name_lenght"} and names("lenght") == set()
        assert names("a_key") == {"a_key", "abkey"} and names("a\\_key") == {"a_key"} and names("a!_%", "!") == {"a_key"}
        assert names("%\\%") == {"50%"} and len(names("%")) == 4
    finally:
        catalog.unregister(spark, "shop_catalog")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1     # external: the data stays
    with pytest.raises(ValueError, match="escape"):
        tables.columns_like({}, "a\\")


def test_published_versions_are_registered_with_comments(spark, tmp_path):
    reviews = spark.createDataFrame([], schemas.typed_schema("order_reviews"))
    tables.reload(spark, str(tmp_path), {"order_reviews": reviews}, lambda written: None)
    version = tables.current_version(spark, str(tmp_path))
    catalog.register(spark, "shop_versions", {"order_reviews": f"{tmp_path}/{version}/order_reviews"}, str(tmp_path / "db"))
    try:
        (row,) = catalog.columns(spark, "shop_versions").where("column = 'embedding'").collect()
        assert (row["table"], row["type"], row["nullable"]) == ("order_reviews", "array<float>", True)
        assert row["description"] == schemas.COMMENTS["embedding"]
        catalog.register(spark, "shop_versions", {}, str(tmp_path / "db"))
        assert catalog.columns(spark, "shop_versions").collect() == []
    finally:
        catalog.unregister(spark, "shop_versions")


def test_a_column_added_later_is_null_in_old_versions(spark, tmp_path):
    root, schema = str(tmp_path), schemas.typed_schema("order_reviews")
    row = ("o1", "r1", 5, None, "text", None, None, [0.5])
    loose = "order_id string, review_id string, review_score int, review_comment_title string, review_comment_message string, " \
            "review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz, embedding array<float>"
    new = spark.createDataFrame([row], loose)
    for df in (new.drop("embedding"), new):
        tables.reload(spark, root, {"order_reviews": df}, lambda written: None)
    found = tables.read_versions(spark, root, "order_reviews", schema)
    assert sorted((r["version"], r["embedding"]) for r in found.collect()) == [(1, None), (2, [0.5])]
    assert found.schema["embedding"].metadata["comment"] == schemas.COMMENTS["embedding"]
    assert tables.read_versions(spark, root, "order_reviews").columns == [*new.columns, "version"]
