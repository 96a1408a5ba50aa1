"""Gaussian-process regression by random features, for any number of observations.

A Matern 5/2 kernel is the average of cosines over frequencies drawn from its
spectral density (a Student t with five degrees of freedom), so with ``M`` drawn
frequencies phi(x) = sqrt(2 s / M) cos(w x + b) gives phi(x) . phi(y) close to
k(x, y), with an error of about s / sqrt(M). The model is then linear in M
features: tasks add up the Gram matrix of their rows, Spark sums its entries, and
only that M x M system is solved on the driver, whatever the number of rows.
Frequencies come from a fixed seed, so a refit gives the same model.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Random features; the system solved on the driver has this many rows.
FEATURES = 384
SEED = 20


class RandomFeatures:
    """Frequencies and phases for a Matern 5/2 kernel on ``d`` inputs."""

    def __init__(self, d: int, length: float, signal: float, n: int = FEATURES, seed: int = SEED):
        rng = np.random.default_rng(seed)
        # a Student t with 5 degrees of freedom: a normal over the root of a scaled chi-square
        self.w = rng.standard_normal((d, n)) / np.sqrt(rng.chisquare(5, n) / 5) / length
        self.b = rng.uniform(0, 2 * np.pi, n)
        self.scale = np.sqrt(2 * signal / n)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.scale * np.cos(x @ self.w + self.b)


class Posterior:
    """Mean and sigma at new points, from summed statistics of the observations."""

    def __init__(self, phi: RandomFeatures, gram: np.ndarray, right: np.ndarray, noise: float, mean: float, scale: float):
        low = np.linalg.cholesky(gram + noise * np.eye(len(gram)))
        self.phi, self.noise, self.mean, self.scale = phi, noise, mean, scale
        self.low_inverse = np.linalg.inv(low)
        self.weights = self.low_inverse.T @ (self.low_inverse @ right)

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        f = self.phi(x)
        spread = np.sqrt(self.noise * np.square(f @ self.low_inverse.T).sum(1))
        return f @ self.weights * self.scale + self.mean, spread * self.scale


def fit(observed: DataFrame, feats: Sequence[str], y: str, length: float, signal: float, noise: float,
        features: int = FEATURES, seed: int = SEED) -> Posterior:
    """One pass for the outcome's mean and spread, one for the Gram matrix."""
    feats = list(feats)
    rows = observed.select(*[F.col(f).cast("double").alias(f) for f in feats], F.col(y).cast("double").alias("_y")).dropna()
    n, mean, scale = rows.agg(F.count(F.lit(1)), F.avg("_y"), F.stddev_pop("_y")).first()
    if not n:
        raise ValueError("no observed rows to fit")
    scale = scale or 1.0
    phi = RandomFeatures(len(feats), length, signal, features, seed)
    m = features
    upper = np.triu_indices(m)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram, right = np.zeros((m, m)), np.zeros(m)
        for b in batches:
            for i in range(0, len(b), 4096):
                f = phi(b[feats].to_numpy(float)[i:i + 4096])
                gram += f.T @ f
                right += f.T @ ((b["_y"].to_numpy(float)[i:i + 4096] - mean) / scale)
        v = np.concatenate([gram[upper], right])
        yield pd.DataFrame({"i": np.arange(len(v)), "v": v})
    total = np.zeros(len(upper[0]) + m)
    for r in rows.mapInPandas(sums, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toLocalIterator():
        total[r["i"]] = r["v"]
    gram = np.zeros((m, m))
    gram[upper] = total[:-m]
    gram = gram + np.triu(gram, 1).T
    return Posterior(phi, gram, total[-m:], noise, mean, scale)


def score(candidates: DataFrame, posterior: Posterior, feats: Sequence[str], id_col: str) -> DataFrame:
    """``id_col, mu, sigma`` for every candidate, in Arrow batches."""
    feats = list(feats)
    sent = candidates.sparkSession.sparkContext.broadcast(posterior)  # FEATURES x FEATURES
    kind = candidates.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            mu, sigma = sent.value(b[feats].to_numpy(float))
            yield pd.DataFrame({id_col: b[id_col], "mu": mu, "sigma": sigma})
    return candidates.select(id_col, *feats).mapInPandas(run, f"{id_col} {kind}, mu double, sigma double")
