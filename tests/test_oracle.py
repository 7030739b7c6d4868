"""Every registered query next to its SQL, on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))
from compare import TABLES, compare  # noqa: E402
from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from shelfwise.plans import ORACLE, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    outcome = compare(spark, db, FOLDER, name)
    assert outcome.startswith(("ok", "rows")), outcome


def test_registry(spark):
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())
    assert len(set(QUERIES) - set(ORACLE)) <= 3
    assert entry(spark).count() > 0
