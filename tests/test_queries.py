import duckdb
import pytest

import __spark_entry__ as entries
from check import TABLES, compare

SQL = entries.oracle_sql()
OWN = [name for name in entries.queries() if name not in entries.LLM_QUERIES]


@pytest.fixture(scope="module")
def tables(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(OWN) <= set(SQL)


def test_entry_has_rows(spark):
    assert entries.entry(spark).count() > 0


@pytest.mark.parametrize("name", OWN)
def test_query_agrees_with_sql(spark, tables, sf_dir, name):
    problem, n = compare(spark, tables, sf_dir, name, entries.queries()[name], SQL[name])
    assert problem is None and n > 0
