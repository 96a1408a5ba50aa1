"""Whitening against a dense eigen-decomposition, and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vialflow.llm import whitening
from vialflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def check(rows, ids, vectors, components, scale=64):
    """``rows`` of ``whiten`` against numpy on the vectors that take part."""
    x = np.floor(scale * np.array(vectors, float)) + 1_000_000
    n, centred = len(x), x - x.mean(0)
    value, vector = np.linalg.eigh(centred.T @ centred / n)
    value, vector = value[::-1], vector[:, ::-1]
    k = min(components, int((value > 1e-12 * value[0]).sum()))
    assert len(rows) == n * k
    got = np.empty((n, k))
    at = {i: j for j, i in enumerate(ids)}
    exact = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(r, x.sum(0))) for r in x.astype(int)]
    for r in rows:
        j = at[r["vec_id"]]
        got[j, r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["deviation"] == exact[j] and r["identity_error"] <= 1e-9
        assert r["explained"] == pytest.approx(value[r["component"] - 1] / value.sum(), rel=1e-9)
    want = centred @ vector[:, :k] / np.sqrt(value[:k])
    for c in range(k):
        assert np.abs(got[:, c] * np.sign(got[:, c] @ want[:, c]) - want[:, c]).max() < 1e-6
    return got


def test_query_equals_dense_eigenvectors(spark):
    rows = QUERIES["op11_whitening"](spark, SF).collect()
    table = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    assert len({(r["vec_id"], r["component"]) for r in rows}) == len(rows)
    check(rows, [r["vec_id"] for r in table], [r["embedding"] for r in table], 32)


@pytest.mark.parametrize("guard", [2, 30])
def test_random_vectors_and_repeated_rows(ready, guard):
    rng = np.random.default_rng(5)
    v = rng.standard_normal((300, 24)) * np.linspace(3, 0.5, 24)
    v = np.vstack([v, np.repeat(v[:1], 200, 0)])  # one vector holds two fifths of the rows
    df = ready.createDataFrame([(i, [float(a) for a in r]) for i, r in enumerate(v)], "vec_id long, embedding array<float>")
    rows = whitening.whiten(df.repartition(5), components=6, guard=guard).collect()
    check(rows, range(len(v)), v.astype(np.float32), 6)


def test_spectrum_with_ties_and_few_passes():
    d = np.array([9.0, 9.0, 9.0, 5.0] + [1.0] * 60 + [0.0] * 36)
    basis = np.linalg.qr(np.random.default_rng(3).standard_normal((100, 100)))[0]
    v = (basis * d) @ basis.T
    value, vector, passes = whitening.eigenpairs(lambda q: v @ q, 100, 4, guard=4)
    assert np.allclose(value, d[:4]) and passes < 60
    assert np.allclose(v @ vector, vector * value, atol=1e-9) and np.allclose(vector.T @ vector, np.eye(4))


def test_odd_rows(ready):
    rng = np.random.default_rng(8)
    good = [(i, [float(a) for a in rng.standard_normal(5)]) for i in range(40)] + [(None, [1.0, 2.0, 0.5, -1.0, 0.25])]
    short = [(90, [0.5, 1.0])]
    bad = [(91, None), (92, []), (93, [1.0, None, 0.0, 0.0, 0.0]), (94, [float("nan")] * 5), (95, [float("-inf")] * 5),
           (96, [1e300] * 5)]
    df = ready.createDataFrame(good + short + bad, "vec_id long, embedding array<double>")
    df = df.withColumns({c: F.lit("extra") for c in ("id", "x", "n", "v", "component", "whitened")})
    rows = whitening.whiten(df, components=3, guard=1).collect()
    check(rows, [i for i, _ in good + short], [v + [0.0] * (5 - len(v)) for _, v in good + short], 3)


def test_no_variance_and_no_rows(ready):
    schema = "vec_id long, embedding array<double>"
    same = ready.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], schema)
    for df in (same, same.where("1 = 0"), same.withColumn("embedding", F.lit(None).cast("array<double>"))):
        out = whitening.whiten(df)
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert out.collect() == []
    line = ready.createDataFrame([(i, [float(i), 0.0, 0.0]) for i in range(9)], schema)
    assert {r["component"] for r in whitening.whiten(line).collect()} == {1}


def test_deviation_beyond_64_bits_is_null():
    x = np.array([[1 << 40, 5], [7, 5]])
    out = whitening._deviations(x, 1 << 20, np.array([0, 5]), np.array([3, 0])).to_pylist()
    assert out == [None, (7 * (1 << 20) - 3) ** 2]
