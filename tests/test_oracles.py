"""Every registered query against its SQL, run by DuckDB over the same tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SQL_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
    "double": "DOUBLE", "date": "DATE",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def ordered(rows, columns):
    index = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in index) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


def test_same_names():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    sql = duck.sql(entry.oracle_sql()[name])
    types = {f.name: SQL_TYPES[f.dataType.simpleString()] for f in df.schema}
    assert types == dict(zip(sql.columns, map(str, sql.types)))
    got, want = df.collect(), sql.fetchall()
    assert len(got) == len(want)
    assert ordered(got, df.columns) == ordered(want, sql.columns)


def test_entry(spark):
    assert entry.entry(spark).count() == 1000
