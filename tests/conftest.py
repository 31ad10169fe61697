from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pricewright.plans import star  # noqa: E402
from pricewright.session import build_session  # noqa: E402
from pricewright.sources import raw  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": 4,
            "spark.ui.enabled": "false",
            "spark.sql.maxMetadataStringLength": 2000,
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("catalog")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def documents(spark, tmp_path_factory):
    """The embedded snapshot, written and read back."""
    path = str(tmp_path_factory.mktemp("raw") / "doc")
    raw.write_raw(raw.document_frame(spark, raw.embedded_document()), path)
    return raw.read_raw(spark, path)


@pytest.fixture(scope="session")
def tables(documents):
    built, _ = star.build_tables(documents)
    return {name: df.cache() for name, df in built.items()}


def rows(df, *columns):
    """Rows as tuples, sorted."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
