"""Every registered query against its SQL twin on the smallest tables."""

import os

import duckdb
import pytest

from oracle import ORACLE_SQL
from queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def canonical(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        # whole numbers may arrive as int, decimal or double
        return (v is None, "" if v is None else repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v))

    return sorted(columns), sorted(tuple(plain(row[i]) for i in order) for row in data)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    want = duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert canonical(got.columns, got.collect()) == canonical(columns, want.fetchall())
