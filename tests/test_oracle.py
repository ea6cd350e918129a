"""Every registered query equals its SQL oracle (DuckDB) bit-for-bit at sf0.001."""
import datetime as dt
import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as se
from respawn.plans.catalog import queries
from respawn.plans.oracle import oracle_sql
from respawn.sources.driver import DRIVER_TABLES
from conftest import SF_SMALL

QUERIES, ORACLE = queries(), oracle_sql()
KEYS = sorted(QUERIES)


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v.hex()
    if isinstance(v, Decimal):
        return float(v).hex()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v if isinstance(v, (bool, int)) else str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "player_id"


def test_every_key_has_docs_and_oracle_or_is_rows_only():
    rows_only = set(KEYS) - set(ORACLE)
    assert not rows_only, rows_only
    assert set(ORACLE) <= set(KEYS) <= set(se.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    rows = df.collect()
    if key not in ORACLE:
        assert len(rows) > 0
        return
    res = con.execute(ORACLE[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    oidx = {c: i for i, c in enumerate(ocols)}
    a = sorted(tuple(str(_norm(r[i])) for i in order) for r in rows)
    b = sorted(tuple(str(_norm(r[oidx[df.columns[i]]])) for i in order) for r in orows)
    assert a == b
