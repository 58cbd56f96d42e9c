"""Every registered query against its SQL counterpart, on whole tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float) and not math.isnan(v):
            return repr(v)
        return repr(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def test_registry_is_complete():
    from oracle_queries import ORACLE

    assert set(ORACLE) == set(driver.QUERIES)
    assert set(driver.queries()) >= set(driver.QUERIES)


@pytest.mark.parametrize("name", sorted(driver.QUERIES))
def test_matches_sql(spark, duck, name):
    df = driver.queries()[name](spark, SF_DIR)
    got = [tuple(r) for r in df.collect()]
    want = duck.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    expected = want.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert len(got) == len(expected) and len(got) > 0
    assert canonical(df.columns, got) == canonical(columns, expected)
