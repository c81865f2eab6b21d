import duckdb
import pytest
from check import TABLES

COLUMNS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, row_id string, _row int, _copy int,"
    " size string, target string, score string, hashes int, node int, `a.b` int"
)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    long = " ".join(f"word{k % 997} and{k % 31}" for k in range(30_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog again and again today", "en", "s1"),
        (1, "the quick brown fox jumps over the lazy dog again and again today", "en", "s1"),
        (2, "the  quick brown\nfox jumps over the lazy dog again and again today", "en", "s2"),
        (3, None, None, None),
        (4, "", "en", ""),
        (5, " \t\n ", None, "s1"),
        (None, "the quick brown fox jumps over the lazy dog again and again today", None, None),
        (None, None, None, None),
        (6, long, "en", "s3"),
        (7, long + " tail", "en", "s3"),
        (8, "x" * 200_000, "de", None),
        (9, "漢字かな交じり文 😀 ünïcödé ελληνικά", "ja", "s1"),
        (10, "a", "en", "s2"),
        (11, "12345 !!! ???", "en", "s2"),
    ]
    extra = ("r", 1, 2, "z", "t", None, 3, 4, 5)
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), *extra) for r in rows], COLUMNS)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def tables():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{table}.parquet')")
    yield con
    con.close()


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
