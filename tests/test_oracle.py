"""Every query against its DuckDB SQL: same columns, same rows."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

from checks.oracle_queries import ORACLES
from checks.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("events", "orders", "lineitem", "documents")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def _cell(x):
    return float(x) if type(x).__name__ == "Decimal" else x


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = _bag(df.columns, df.collect())
    cur = duck.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    want = _bag(names, cur.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert got, "no rows"
    missing, extra = want - got, got - want
    assert not missing and not extra, (
        f"{sum(missing.values())} missing, {sum(extra.values())} extra of {sum(want.values())}\n"
        f"want {next(iter(missing), None)}\ngot  {next(iter(extra), None)}"
    )
