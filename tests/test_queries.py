"""Registered queries against DuckDB, on the smallest tables."""

import decimal
import importlib.util
from pathlib import Path

import pytest

from trailmark import plans

duckdb = pytest.importorskip("duckdb")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return round(float(v), 6) + 0.0
    return str(v)


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_same_rows_as_sql(spark, duck, sf_dir, name):
    got = plans.QUERIES[name](spark, sf_dir)
    columns = sorted(got.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    want = duck.execute(plans.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    assert rows == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in want.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLES)))
def test_runs(spark, sf_dir, name):
    assert plans.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    spec = importlib.util.spec_from_file_location("__spark_entry__", Path(__file__).resolve().parent.parent / "__spark_entry__.py")
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(plans.QUERIES) <= set(entry.queries())
