"""Every query with an oracle, at the smallest scale: the same rows from DuckDB."""

import duckdb
import pytest

from netsounder.plans import registry
from netsounder.session import TABLES

QUERIES, ORACLES = registry.queries(), registry.oracles()


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, bool):
        return int(v)
    return float(f"{v:.9g}") if isinstance(v, (int, float)) else str(v)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(name, spark, duck, sf):
    got = QUERIES[name](spark, sf)
    cur = duck.execute(ORACLES[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(got.columns)
    want = sorted((tuple(plain(r[columns.index(c)]) for c in sorted(columns)) for r in cur.fetchall()), key=str)
    have = sorted((tuple(plain(r[c]) for c in sorted(columns)) for r in got.collect()), key=str)
    assert have == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(name, spark, sf):
    assert len(QUERIES[name](spark, sf).collect()) > 0
