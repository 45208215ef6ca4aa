"""Every registered query of the curation library against its DuckDB counterpart, on the smallest tables."""

import decimal
import pathlib

import duckdb
import pytest

from wrenfield.registry import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
TABLES = "events documents pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not pathlib.Path(DATA).exists(), reason="needs the driver's tables")


def plain(x):
    if isinstance(x, (float, decimal.Decimal)):
        return round(float(x), 6)
    return tuple(map(plain, x)) if isinstance(x, (list, tuple)) else x


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_duckdb(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    cols = sorted(got.columns)
    want = duck.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == cols
    rows = [tuple(plain(r[names.index(c)]) for c in cols) for r in want.fetchall()]
    assert sorted(map(lambda r: tuple(map(plain, r)), got.select(cols).collect()), key=str) == sorted(rows, key=str)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() >= 0
