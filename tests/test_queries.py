"""Every registered query against its SQL, on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from check import TABLES, compare  # noqa: E402
from millrace import queries as registry  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    db = duckdb.connect()
    for table in TABLES.split():
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return db


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, database, name):
    found = entry.queries()[name](spark, FOLDER)
    result = database.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert not compare([tuple(r) for r in found.collect()], found.columns, result.fetchall(), columns)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
