"""Every query next to its SQL on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from talkloom.plans import registry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def rounded(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(rounded(r[c]) for c in columns) for r in df.collect()), key=repr)
    cursor = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted((tuple(rounded(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=repr)
    assert got == want


def test_queries_without_sql_are_few():
    """Those have plain versions elsewhere in the tests."""
    assert set(registry.queries()) - set(registry.oracle_sql()) == {"sequential_draws"}
