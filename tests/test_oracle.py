"""Every registered query against its DuckDB oracle (small scale factor)."""

import os

import duckdb
import pytest

import __spark_entry__ as se
from claimflow.plans.catalog import ORACLE, QUERIES
from tools.check_oracle import TABLES, digest

from conftest import SF_SMALL

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES) <= set(se.queries())
    assert ORACLE.items() <= se.oracle_sql().items() and set(se.oracle_sql()) <= set(se.queries())


def test_entry_smoke(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert df.columns == ["priority_band", "claims"]
    assert sum(r.claims for r in rows) > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    sh, sl = digest(sdf.columns, srows)
    dh, dl = digest(dcols, drows)
    assert sh == dh, (sorted(set(sl) - set(dl))[:2], sorted(set(dl) - set(sl))[:2])
