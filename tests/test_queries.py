"""Every registered query against its SQL, over the whole tables of the smallest data set."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from queries import batch, replication

SF_DIR = os.environ.get("ITEMFLOW_TEST_DATA", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        if isinstance(v, float):
            return ("nan",) if math.isnan(v) else float(f"{v:.9g}")
        return v

    out = [tuple(cell(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(out, key=repr)


def kind(spark_type):
    return {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}[spark_type]


def test_every_query_has_an_oracle():
    """But for those of the optional subpackage, which names a test for each that SQL cannot express."""
    assert set(oracle_sql()) <= set(queries())
    assert set(batch.QUERIES) | set(replication.QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    result = duck.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    kinds = dict(zip(names, (str(d[1]) for d in result.description)))
    want = canonical(names, result.fetchall())
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    assert got[0] == want[0]
    assert got[1] == want[1]
    assert want[1], "a query that returns nothing shows nothing"
    assert {n: kind(t) for n, t in df.dtypes} == kinds


def test_entry(spark):
    assert entry(spark).count() == 1500
