"""Every registered query: equal to its SQL, and with a plan that scales."""

import duckdb
import pytest

import __spark_entry__ as entry
from compare import database, differences
from stallbook.operators import analytics, ordered
from stallbook.plans import registry

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con() -> duckdb.DuckDBPyConnection:
    return database(SMALL)


def test_every_query_has_sql():
    assert set(registry.queries()) <= set(entry.queries()) and set(registry.queries()) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["months", "revenue"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_its_sql(spark, con, name):
    assert differences(spark, con, name, SMALL) is None


def plan(spark, name):
    return registry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no side is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_join_of_everything_with_everything(spark, no_broadcast, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_status_filter_and_columns_reach_the_scan(spark):
    text = plan(spark, "monthly_revenue")
    assert "Not(EqualTo(o_orderstatus,P))" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in text


def test_facts_are_summed_before_they_are_joined(spark, no_broadcast, monkeypatch):
    # What is written down on the way would be out of the plan's sight.
    for module in (analytics, ordered):
        monkeypatch.setattr(module, "pinned", lambda df: df)
    for name in ("monthly_revenue", "running_spend", "repeat_share", "top_products", "seller_ranks"):
        sides = [part for part in plan(spark, name).split("SortMergeJoin") if "FileScan parquet [l_" in part]
        assert sides and all("partial_" in part for part in sides), name


def test_seed_filter_is_pushed(spark):
    assert "EqualTo(vec_id,0)" in plan(spark, "nearest_cosine")
