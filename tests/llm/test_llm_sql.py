"""Every query of the package against its SQL, and its shape without one."""

import math
import os

import duckdb
import pytest

from vialflow.llm.queries import ORACLE, QUERIES

SF = os.environ.get("VIALFLOW_TEST_SF", "/root/testdata/sf0.001")
TABLES = "documents embeddings benchmark labels conversations".split()


def _norm(v):
    return round(v, 6) + 0.0 if isinstance(v, float) and not math.isnan(v) else v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    assert got and got == _rows(cols, res.fetchall())


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
