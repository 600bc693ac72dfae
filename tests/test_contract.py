"""Every query with SQL against DuckDB, on the smallest tables."""

import math
import os
from collections import Counter
from decimal import Decimal

import pytest

from tidemark.plans import contract, problems

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
QUERIES, ORACLES = {**contract.QUERIES, **problems.QUERIES}, {**contract.ORACLES, **problems.ORACLES}


def plain(v):
    if isinstance(v, (float, Decimal)):
        return None if math.isnan(v) else round(float(v), 6)
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat(" ")
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{DATA}/{f}')")
    return c


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in ORACLES:
        return
    want = con.sql(ORACLES[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert got == Counter(tuple(plain(r[i]) for i in at) for r in want.fetchall())
