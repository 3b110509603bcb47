"""Every registered query against its DuckDB SQL over the smallest tables."""

import math
import os

import duckdb
import pytest

from colloquy.plans.catalogue import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: ("nan" if math.isnan(v) else repr(v + 0.0)) if isinstance(v, float) else repr(v)
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    found = duck.execute(ORACLES[name])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows([c[0] for c in found.description], found.fetchall())
