"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import math
import os

import duckdb
import pytest

from strata.plans.registry import ORACLE, QUERIES
from strata.tables import TABLES

SF = os.environ.get("STRATA_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


def test_every_query_is_registered_with_oracle_or_documented():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 45


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF)
    cols = sorted(sdf.columns)
    srows = [r.asDict() for r in sdf.collect()]
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    drows = [dict(zip(dcols, r)) for r in cur.fetchall()]
    assert sorted(dcols) == cols
    assert len(srows) == len(drows)
    assert _rows(srows, cols) == _rows(drows, cols)
