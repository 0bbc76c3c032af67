"""The correctness gate on the smoke tables: every query with an oracle
equals its DuckDB SQL (row count, column names, sorted values)."""

import math

import pytest

from churnlake.plans.registry import QUERIES, oracles
from conftest import SMOKE

ORACLES = oracles()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, oracle_db, name):
    df = QUERIES[name](spark, SMOKE)
    srows = [tuple(r) for r in df.collect()]
    res = oracle_db.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _rows(df.columns, srows) == _rows(ocols, orows)
