"""Every registered query against its SQL on the smallest scale folder."""

import os

import __spark_entry__ as entry
import check
import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in check.TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


@pytest.mark.skipif(not os.path.isdir(SF), reason="no benchmark tables here")
@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, db, name):
    got = entry.queries()[name](spark, SF).toPandas()
    if name not in entry.oracle_sql():
        assert len(got) > 0
        return
    want = db.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert check.digest(got)[0] == check.digest(want)[0]


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
