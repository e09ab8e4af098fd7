"""Every registered query against its SQL on the smallest benchmark tables."""

import math
import os

import pytest

import __spark_entry__ as entry_points
from vidmart import oracle, queries

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
QUERIES = queries.registered()
SQL = oracle.sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no benchmark tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def comparable(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, bool) or v is None or isinstance(v, str):
            return v
        return None if math.isnan(float(v)) else float(v)

    return sorted((tuple(value(r[i]) for i in order) for r in records), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries())
    assert SQL.items() <= entry_points.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    want = comparable(columns, cursor.fetchall())
    assert want, "an empty result proves nothing"
    assert comparable(df.columns, df.collect()) == want


def test_entry(spark):
    assert entry_points.entry(spark).count() == 5
