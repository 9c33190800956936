"""Every catalogue query against its SQL in DuckDB."""

import duckdb
import pytest

from sheafmill.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks".split()
#: Spark and DuckDB names of the types that results have.
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(catalogue.queries()) - set(catalogue.oracle_sql()) == {"knn_indexed"}  # approximate; tests/test_vectorindex.py measures its recall
    assert len(catalogue.queries()) >= 50


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query(spark, duck, name):
    got = catalogue.queries()[name](spark, SF)
    want = duck.sql(catalogue.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert {c: TYPES[k] for c, k in got.dtypes} == dict(zip(want.columns, map(str, want.types)))
    order = [want.columns.index(c) for c in columns]
    rows = sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str)
    assert rows == sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=str)
