"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_point

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}
QUERIES, SQL = entry_point.catalog.QUERIES, entry_point.catalog.ORACLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    result = duck.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})")
    types = [str(d[1]) for d in result.description]
    want = result.fetchall()
    assert [TYPES[df.schema[c].dataType.simpleString()] for c in columns] == types
    assert ordered(got) == ordered(want)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_entry(spark):
    rows = entry_point.entry(spark)
    assert rows.count() == 77
