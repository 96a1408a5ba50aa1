"""Every registered job against its DuckDB SQL answer (sf0.001 by default;
set VIALFLOW_TEST_SF to another fixture folder for a larger run)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from vialflow import plans
from vialflow.sources.tables import TABLES

SF = os.environ.get("VIALFLOW_TEST_SF", "/root/testdata/sf0.001")
QUERIES = {k: v for k, v in E.queries().items() if k in plans.QUERIES}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in plans.QUERIES}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return _norm(tuple(v))
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_registered_has_callable():
    assert QUERIES, "no queries registered"
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, res.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_are_sound(spark, name):
    """No NULL-only column or NaN but where the job says so, shares between 0 and 1,
    and for jobs that draw or pick at random the same rows again."""
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    assert rows and len({f.name for f in df.schema}) == len(df.columns)
    shares = ("accuracy", "val_accuracy", "oob_accuracy", "p1", "py", "ps", "prior", "probability", "draw")
    for c in df.columns:
        values = [r[c] for r in rows if r[c] is not None]
        assert values or c in ("error", "ei"), c
        assert not any(isinstance(v, float) and math.isnan(v) for v in values), c
        if c in shares:
            assert all(0 <= v <= 1 for v in values), c
    if name in ("thompson_draw", "suggest_batch", "gp_score", "pu_learning"):
        rough = lambda rs: _rows(df.columns, [[round(v, 3) if isinstance(v, float) else v for v in r] for r in rs])
        assert rough(rows) == rough(QUERIES[name](spark, SF).collect())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns[:4] == ["l_returnflag", "l_linestatus", "l_discount", "l_tax"]
    assert all(r["coverage"] >= 8 for r in rows)
