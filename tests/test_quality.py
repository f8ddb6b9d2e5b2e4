import pytest

import shop
from stallbook.operators import quality
from stallbook.plans import retail
from stallbook.sources import tables

EXPECTED = retail.Expectations(landed_rows=shop.LANDED_ROWS, typed_rows=shop.TYPED_ROWS, imputed_orders=1,
                               undelivered_orders=3, fallback_products=1, delivered_before_handover=0)


def results(report):
    return {(r["check"], r["subject"]): (r["actual"], r["passed"]) for r in report.collect()}


def test_the_clean_shop_passes_every_check(typed, landed):
    report = retail.typed_report(typed, landed, retail.typed_checks(EXPECTED))
    failed = {k: v for k, v in results(report).items() if not v[1]}
    assert failed == {}
    assert report.count() == len(retail.typed_checks(EXPECTED))
    quality.enforce(report)


def test_whole_job_from_csv(spark, raw_folder, tmp_path):
    root = str(tmp_path / "shop")
    retail.build_from_csv(spark, raw_folder, root, EXPECTED)
    published = tables.read_published(spark, root, retail.TABLES)
    assert {name: df.count() for name, df in published.items()} == shop.TYPED_ROWS


def test_wrong_count_stops_the_job_before_publishing(spark, landed, tmp_path):
    wrong = retail.Expectations(landed_rows=shop.LANDED_ROWS, typed_rows={**shop.TYPED_ROWS, "orders": 11},
                                imputed_orders=2, undelivered_orders=3, fallback_products=1)
    with pytest.raises(quality.QualityError) as error:
        retail.build(landed, str(tmp_path / "shop"), wrong)
    assert "2 checks failed" in str(error.value)
    assert "expected 11, got 10" in str(error.value) and "imputed_dates" in str(error.value)
    with pytest.raises(Exception):
        tables.current_version(spark, str(tmp_path / "shop"))


def test_a_long_subject_is_not_cut(typed, landed):
    wrong = retail.Expectations(landed_rows={}, typed_rows={}, fallback_products=7, undelivered_orders=3, imputed_orders=1)
    lines = quality.failures(retail.typed_report(typed, landed, retail.cleaning_checks(wrong))).collect()
    assert [r["line"] for r in lines] == [
        "reference products.product_category_name -> product_category_translation expected 7, got 1"]


def test_landing_gate(spark, landed, tmp_path):
    with pytest.raises(quality.QualityError, match="customers"):
        retail.build(landed, str(tmp_path), retail.Expectations(landed_rows={"customers": 12}))


def test_each_check_finds_its_defect(spark):
    found = {
        "t": spark.createDataFrame([(1, "a", 5), (1, "b", 6), (None, None, None), (2, "z", -1)],
                                   "id int, ref string, n int"),
        "p": spark.createDataFrame([("a",), ("b",), ("c",)], "ref string"),
    }
    report = results(quality.run_checks(found, [
        quality.RowCount("t", 4), quality.RowCount("p", 4),
        quality.UniqueKey("t", ("id",)), quality.UniqueKey("t", ("id", "ref")),
        quality.Reference("t", "ref", "p"), quality.HasChild("p", "ref", "t"),
        quality.Rule("t", "n_small", "n BETWEEN 0 AND 5"), quality.NotNull("t", "ref"),
        quality.Rule("t", "n_any", "n > 5", expected=None),
        quality.Count("t", "big", "n > 4", 2), quality.Count("t", "few", "n > 4", 1, at_most=True),
        quality.Matches("t", "with_a", "n > 0", "ref", "p", "ref <> 'b'", 1),
        quality.NoColumnLike("re"),
    ]))
    assert report == {
        ("row_count", "t"): (4, True), ("row_count", "p"): (3, False),
        ("unique_key", "t(id)"): (1, False), ("unique_key", "t(id, ref)"): (0, True),
        ("reference", "t.ref -> p"): (1, False), ("has_child", "p.ref <- t"): (1, False),
        ("rule", "t.n_small"): (2, False), ("not_null", "t.ref"): (1, False), ("rule", "t.n_any"): (2, True),
        ("count", "t.big"): (2, True), ("count", "t.few"): (2, False),
        ("matches", "t.with_a"): (1, True), ("no_column_like", "re"): (2, False),
    }


def test_row_checks_share_one_scan(typed, landed):
    checks = [c for c in retail.typed_checks(EXPECTED)
              if isinstance(c, (quality.RowCount, quality.NotNull, quality.Rule, quality.Count))
              and c.table == "orders"]
    plan = quality.run_checks(typed, checks)._jdf.queryExecution().executedPlan().toString()
    assert len(checks) > 5 and plan.count("FileScan") == 1


def test_reported_rules_never_fail(typed, landed):
    report = retail.typed_report(typed, landed, quality.reported_rules(box=(-34, 6, -74, -34)))
    assert results(report) == {
        ("rule", "orders.carrier_after_purchase"): (0, True),
        ("rule", "orders.delivered_after_carrier"): (0, True),
        ("rule", "products.weight_positive"): (1, True),
        ("rule", "geolocation.coordinates_in_box"): (0, True),
    }


def test_checks_on_rows_come_from_the_write(spark, landed, typed, tmp_path):
    """The same report as reading the published tables again, without reading one."""
    checks = [*quality.row_counts(shop.TYPED_ROWS), *quality.not_nulls(), *quality.row_rules(), *quality.reported_rules(),
              quality.Count("orders", "delivered", "order_status = 'delivered'", 100, at_most=True)]
    root = str(tmp_path / "shop")
    retail.build(landed, root, EXPECTED, checks)
    report = retail.published_report(spark, root, checks)
    assert results(report) == results(quality.run_checks(typed, checks)) and report.count() == len(checks)
    assert "FileScan" not in report._jdf.queryExecution().executedPlan().toString()
