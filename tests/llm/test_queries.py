"""The registered operators against their SQL in DuckDB."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

from check_queries import rows_of  # noqa: E402
from pricewright.llm.queries import ORACLES, QUERIES  # noqa: E402
from pricewright.queries.preparation import ALL_TABLES  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].partition("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for table in ALL_TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    cursor = db.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())
