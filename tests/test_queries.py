"""Every registered query against its SQL in DuckDB, and the shape of the physical plans."""

from __future__ import annotations

import os

import pytest

duckdb = pytest.importorskip("duckdb")

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from check_queries import rows_of  # noqa: E402
from pricewright.queries import ORACLES, QUERIES  # noqa: E402
from pricewright.queries.preparation import ALL_TABLES  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in ALL_TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = db.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def test_every_query_is_registered():
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).columns == ["p_brand", "p_type", "region", "segment", "price_usd", "price_idr"]


def plan(spark, name: str) -> str:
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


PARSED = {"q_nested_items"}  # elements nest, which no expression over text can follow
MODELS = {"q_ridge", "q_gbt_importance", "q_model_compare"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODELS))
def test_no_cross_join_and_no_python_in_plans(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in PARSED:
        assert "Python" not in text and "ArrowEval" not in text


def test_copies_are_cut_down_before_the_shuffle(spark):
    text = plan(spark, "q_dedup_first")
    assert "row_number(), 1, Partial" in text


def test_scans_read_only_what_is_used(spark):
    text = plan(spark, "q_spend_tier")
    assert "ReadSchema: struct<l_extendedprice:double>" in text
    trend = plan(spark, "q_revenue_trend")
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in trend and "LessThan(o_orderdate,1998-01-01" in trend
    assert "PushedFilters: [In(" in plan(spark, "q_semi_filter")


def test_row_level_queries_do_not_shuffle(spark):
    for name in ("q_price_metrics", "q_explode_tiers", "q_page_items", "q_tier_estimates", "q_scenario_features"):
        assert "Exchange" not in plan(spark, name)


def test_top_k_is_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(spark, "q_topk")
