"""Fronts, volumes and nearest rows against brute force."""

import math
import random

import numpy as np
import pytest

from vialflow.operators import nearest, pareto


def brute_front(points):
    pts = set(points)
    return {p for p in pts if not any(q != p and all(a >= b for a, b in zip(q, p)) for q in pts)}


@pytest.mark.parametrize("d,n,block", [(2, 400, 2048), (3, 700, 16), (4, 500, 16), (5, 120, 2048)])
def test_front_equals_brute_force(spark, monkeypatch, d, n, block):
    monkeypatch.setattr(pareto, "BLOCK", block)
    rng = random.Random(d)
    # near the plane of a constant sum, so fronts are large; with repeats and ties
    pts = [tuple(round(x / 3 * 8) / 8 for x in rng.choices(range(9), k=d - 1)) for _ in range(n)]
    pts = [(*p, round(d - sum(p) / 2 + rng.choice([0, 0, -0.5]), 3)) for p in pts] + [(9.0,) * (d - 1) + (0.0,)]
    names = [f"v{i}" for i in range(d)]
    rows = [(i, *p) for i, p in enumerate(pts + pts[:40])] + [(-1, *[None] * d), (-2, *[float("nan")] * d)]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in names))
    want = brute_front(pts)
    assert {tuple(r) for r in pareto.front_nd(df, names).collect()} == want
    got = pareto.pareto_nd(df.repartition(5), names).collect()
    assert len(got) == len(rows)
    assert all(r["on_front"] == (tuple(r[c] for c in names) in want) for r in got)
    assert pareto.front_nd(df.where("1 = 0"), names).collect() == []


@pytest.mark.parametrize("slab", [7, 50_000])
def test_volume_equals_cells(spark, monkeypatch, slab):
    monkeypatch.setattr(pareto, "SLAB", slab)
    rng = np.random.default_rng(3)
    pts = rng.integers(-1, 12, (80, 3)).astype(float)
    cells = np.zeros((12, 12, 12), bool)
    for x, y, z in pts.astype(int):
        if min(x, y, z) > 0:
            cells[:x, :y, :z] = True
    df = spark.createDataFrame([tuple(map(float, p)) for p in pts] + [(None, 1.0, 1.0), (float("nan"), 50.0, 50.0)],
                               "x double, y double, z double")
    assert pareto.hypervolume_3d(df, "x", "y", "z").first()[0] == pytest.approx(cells.sum())
    assert pareto.hypervolume_3d(df.where("1 = 0"), "x", "y", "z").first()[0] == 0.0


@pytest.mark.parametrize("d,per_cell", [(1, 4), (2, 2), (3, 3), (2, 10_000)])
def test_nearest_equals_brute_force(spark, monkeypatch, d, per_cell):
    monkeypatch.setattr(nearest, "PER_CELL", per_cell)
    rng = random.Random(d)
    names = [f"v{i}" for i in range(d)]
    pool = [(i, *[round(rng.gauss(0, 1) ** 3, 2) for _ in names]) for i in range(500)]
    pool += [(1000 + i, *pool[i % 3][1:]) for i in range(300)] + [(-5, *[None] * d), (-6, *[float("inf")] * d)]
    ask = [(i, *[round(rng.uniform(-6, 6), 2) for _ in names]) for i in range(120)]
    ask += [(500, *[1e6] * d), (501, *[-40.0] * d), (502, *pool[0][1:]), (503, *[None] * d), (504, *ask[0][1:])]
    schema = lambda key: f"{key} long, " + ", ".join(f"{c} double" for c in names)
    p, q = spark.createDataFrame(ask, schema("a")), spark.createDataFrame(pool, schema("b"))
    got = {r["a"]: (r["b"], r["distance"]) for r in nearest.nearest(p, q, names, "a", "b").collect()}
    good = [r for r in pool if r[1] is not None and math.isfinite(r[1])]
    assert set(got) == {r[0] for r in ask if r[1] is not None}
    for r in ask:
        if r[1] is not None:
            far, _, best = min((sum((x - y) ** 2 for x, y in zip(r[1:], s[1:])), s[0], s[0]) for s in good)
            assert got[r[0]][0] == best and got[r[0]][1] == pytest.approx(math.sqrt(far))
    assert nearest.nearest(p, q.where("1 = 0"), names, "a", "b").collect() == []


def test_blocks_meet_every_row_once(spark):
    from vialflow.operators.similarity import against
    many, few = spark.range(70).withColumnRenamed("id", "m"), spark.range(50).withColumnRenamed("id", "f")
    got = against(many, few, per_block=8)
    assert got.columns == ["m", "f"] and got.count() == 3500 and got.distinct().count() == 3500
