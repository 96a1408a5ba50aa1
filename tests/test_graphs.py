"""Vector steps, distances and the random-feature process on small inputs."""

import random

import numpy as np
import pytest

from vialflow.operators import graph, kernelfit
from vialflow.operators.planning import gp_score


def test_grid_distances(spark):
    rng = random.Random(1)
    cells = {(x, y) for x in range(9) for y in range(7) if rng.random() > 0.3} | {(0, 0)}
    want, level, d = {(0, 0): 0}, [(0, 0)], 0
    while level:
        d += 1
        level = [c for x, y in level for c in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)) if c in cells and c not in want]
        want |= {c: d for c in level}
        level = list(dict.fromkeys(level))
    got = graph.grid_shortest_path(spark.createDataFrame(sorted(cells), "x int, y int"), (0, 0)).collect()
    assert {(r["x"], r["y"]): r["d"] for r in got} == want and len(want) < len(cells)


def test_long_path_and_unknown_source(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(12)] + [(50, 51)], "src long, dst long")
    assert {r["node_id"]: r["d"] for r in graph.distances(edges, 0).collect()} == {i: i for i in range(13)}
    assert graph.distances(edges, 99).collect() == []


def test_typed_message_is_the_sum_of_messages(spark):
    nodes = {1: [1.0, -2.0], 2: [0.5, 0.0], 3: [0.0, 3.0], 4: [1.0, 1.0]}
    edges = [(1, 2, "a"), (3, 2, "b"), (1, 2, "a"), (2, 3, "?"), (9, 1, "a")]
    e = {"a": [0.1, 0.2], "b": [-1.0, 0.5]}
    ws, wn = np.array([[1.0, 2.0], [-1.0, 0.5], [0.3, 0.3]]), np.array([[0.5, 0.0], [1.0, -1.0], [0.0, 2.0]])
    want = {n: ws @ x for n, x in nodes.items()}
    for s, t, k in edges:
        if s in nodes:
            want[t] = want[t] + wn @ (np.array(nodes[s]) + np.array(e.get(k, [0, 0])))
    got = graph.typed_message(spark.createDataFrame(list(nodes.items()), "node_id long, x array<double>"),
                              spark.createDataFrame(edges, "src long, dst long, type string"), ws.tolist(), wn.tolist(),
                              spark.createDataFrame(list(e.items()), "type string, e array<double>")).collect()
    assert {r["node_id"] for r in got} == set(nodes)
    for r in got:
        assert r["x"] == pytest.approx(np.maximum(want[r["node_id"]], 0))


def matern(a, b, length):
    d = np.linalg.norm(a[:, None] - b[None], axis=2) / length * np.sqrt(5)
    return (1 + d + d * d / 3) * np.exp(-d)


def test_random_features_come_near_the_kernel():
    x = np.random.default_rng(1).uniform(0, 1, (60, 2))
    f = kernelfit.RandomFeatures(2, 0.5, 1.0, 20_000)(x)
    assert np.abs(f @ f.T - matern(x, x, 0.5)).max() < 0.04


def test_process_is_near_the_exact_fit_for_many_rows(spark):
    """3,000 noisy observations: means within 0.05 of the exact process, in
    units of the outcome's spread, and sigmas small where there are data."""
    rng = np.random.default_rng(2)
    x = rng.uniform(0, 1, (3000, 2))
    y = np.sin(4 * x[:, 0]) + x[:, 1] ** 2 + rng.normal(0, 0.1, len(x))
    at = rng.uniform(0.1, 0.9, (40, 2))
    noise, z = 0.02, (y - y.mean()) / y.std()
    exact = matern(at, x, 0.5) @ np.linalg.solve(matern(x, x, 0.5) + noise * np.eye(len(x)), z) * y.std() + y.mean()
    obs = spark.createDataFrame([(*map(float, p), float(v)) for p, v in zip(x, y)] + [(0.5, 0.5, None)], "a double, b double, y double")
    cand = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(at)], "id long, a double, b double")
    got = sorted(gp_score(obs, cand, ["a", "b"], "y", "id", noise=noise).collect())
    assert np.abs(np.array([r["mu"] for r in got]) - exact).max() < 0.05 * y.std()
    assert max(r["sigma"] for r in got) < 0.2 * y.std()
    with pytest.raises(ValueError):
        gp_score(obs.where("1 = 0"), cand, ["a", "b"], "y", "id")
