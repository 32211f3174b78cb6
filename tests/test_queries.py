"""Every registered query beside its SQL, on the whole small tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    assert len(set(df.columns)) == len(df.columns)
    if name in SQL:
        assert differences(df, SQL[name], con) is None
    else:
        assert df.count() > 0


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and sum(r.total for r in rows) > 0
