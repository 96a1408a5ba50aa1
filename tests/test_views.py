"""Warped and masked array views against NumPy."""

import math

import numpy as np
from pyspark.sql import functions as F

from vialflow.functions import spectra as SP


def _unit(key, slot=0):
    import hashlib
    return int(hashlib.md5(key.encode()).hexdigest()[8 * slot:8 * slot + 8], 16) / 2 ** 32


def _normal(key):
    return math.sqrt(-2 * math.log(1 - _unit(key))) * math.cos(2 * math.pi * _unit(key, 1))


def _expected(y, key, seed):
    n, k = len(y), f"{key}:{seed}:"
    shift, scale = int(_unit(k + "shift") * 9) - 4, 1 + 0.015 * _normal(k + "stretch")
    moved = np.clip((np.arange(n) - shift) * scale, 0, n - 1)
    out = np.interp(np.arange(n), moved, y)
    width = min(int(_unit(k + "width") * 30) + 6, n)
    start = int(_unit(k + "start") * (n - width + 1))
    if _unit(k + "band") < 0.5:
        out[start:start + width] = 0.2 * np.linspace(out[start], out[start + width - 1], width)
    lo, hi = out.min(), out.max()
    return out if hi - lo < 1e-9 else (out - lo) / (hi - lo)


def test_views_equal_numpy(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=n).tolist()) for i, n in enumerate([2, 3, 7, 40, 64, 600] * 12)]
    rows.append((100, [2.5] * 9))
    df = spark.createDataFrame(rows, "id long, y array<double>")
    got = {r["id"]: r["v"] for r in df.select("id", SP.array_view(F.col("y"), F.col("id"), 5).alias("v")).collect()}
    for i, y in rows:
        want = _expected(np.array(y), i, 5)
        assert len(got[i]) == len(y)
        assert np.allclose(got[i], want, atol=1e-9), (i, len(y))


def test_views_of_odd_arrays(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [4.0]), (4, [1.0, None, 2.0])], "id long, y array<double>")
    got = {r["id"]: r["v"] for r in df.select("id", SP.array_view(F.col("y"), F.col("id"), 5).alias("v")).collect()}
    assert got[1] is None and got[2] == [] and len(got[3]) == 1 and len(got[4]) == 3
