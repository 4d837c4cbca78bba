"""Every query that has an SQL twin against DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from logweave.plans import catalog, domain_catalog, reached_catalog, state_catalog, stored_catalog  # noqa: F401  (registers its queries)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


def plain(v):
    if v is None or v != v:
        return "null"
    if isinstance(v, float):
        return str(int(v)) if v == int(v) else f"{v:.6g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert got
    if name in catalog.ORACLES:
        r = duck.sql(catalog.ORACLES[name])
        at = [r.columns.index(c) for c in columns]
        assert len(r.columns) == len(columns)
        assert got == sorted(tuple(plain(row[k]) for k in at) for row in r.fetchall())
