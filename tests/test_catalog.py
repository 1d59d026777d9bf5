"""The driver contract: entry(), and registered queries against their DuckDB oracle."""

import math

import duckdb
import pytest

import __spark_entry__ as contract

from .conftest import SF001

TABLES = ["lineitem", "orders"]
SAMPLE = [
    "edge_line_report",
    "graph_stats_c",
    "adjacency",
    "rank_redistribute_pruned",
    "rank_self_loop_hubs_p",
    "order_ranks",
]


def _rows(records):
    norm = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(norm(x) for x in r) for r in records), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    from vertexrank.catalog import ORACLE_SQL, QUERIES

    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry_runs(spark):
    df = contract.entry(spark)
    rows = df.collect()
    assert df.columns == ["vertex", "rank"] and len(rows) == 360
    assert [r.rank for r in rows] == sorted(r.rank for r in rows)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    df = contract.queries()[name](spark, SF001)
    cols = sorted(df.columns)
    got = _rows(tuple(r[c] for c in cols) for r in df.collect())
    rel = con.sql(contract.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    assert got == _rows(tuple(r[i] for i in idx) for r in rel.fetchall())
