"""Every registered query against its DuckDB oracle on sf0.001 (the driver's
check runs the same comparison on sf0.01; ``tools/check_oracle.py``)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from quietude.plans import catalog
from quietude.sources.tables import DRIVER_TABLES
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (2, v)
    if isinstance(v, bool):
        return (3, str(v))
    if isinstance(v, int):
        return (2, float(v))
    if hasattr(v, "isoformat"):
        return (4, v.isoformat())
    return (5, str(v))


def test_every_query_has_oracle():
    assert set(catalog.QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "geo_zone" in df.columns


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    srows = sorted(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    drows = sorted(tuple(_norm(dict(zip(dcols, r))[c]) for c in cols) for r in cur.fetchall())
    assert srows == drows
