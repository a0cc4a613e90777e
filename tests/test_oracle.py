"""Registered queries against their SQL twins at the smallest scale."""

import os
from collections import Counter

import pytest

import __spark_entry__ as entry
from scriptloom.plans.bind import Corpus
from scriptloom.plans.catalog import QUERIES
from tools.check import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def corpus(spark):
    """One corpus for all queries: layers that several read are built once."""
    return Corpus(spark, FOLDER)


OWN = sorted(name for name in entry.queries() if name.startswith("q_"))


def test_every_query_has_a_twin():
    assert set(OWN) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query(corpus, db, name):
    df = QUERIES[name](corpus)
    cur = db.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    got: Counter = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got == rows_of(cols, cur.fetchall())
