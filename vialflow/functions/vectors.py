"""Vector functions on ``ARRAY<FLOAT|DOUBLE>`` columns.

Spark 4.1 has no vector SQL functions, so these are ``zip_with`` /
``aggregate`` / ``transform`` expressions: evaluated per row in the JVM,
no Python, no Arrow hop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_double(v: Column | str) -> Column:
    return F.transform(_c(v), lambda x: x.cast("double"))


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y), F.lit(0.0),
                       lambda acc, x: acc + x)


def l2norm(a: Column | str) -> Column:
    return F.sqrt(F.aggregate(F.transform(as_double(a), lambda x: x * x), F.lit(0.0), lambda acc, x: acc + x))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; 0 when either norm is 0."""
    na, nb = l2norm(a), l2norm(b)
    return F.when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(dot(a, b) / (na * nb))


def euclid(a: Column | str, b: Column | str) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y)),
                              F.lit(0.0), lambda acc, x: acc + x))


def sq_euclid(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y)),
                       F.lit(0.0), lambda acc, x: acc + x)


def normalise(a: Column | str) -> Column:
    """Unit-length copy (unchanged when the norm is 0)."""
    n = l2norm(a)
    return F.when(n == 0, as_double(a)).otherwise(F.transform(as_double(a), lambda x: x / n))


def minmax_array(a: Column | str) -> Column:
    """Scale values to [0, 1] within the array; a constant array is copied."""
    v = as_double(a)
    lo, hi = F.array_min(v), F.array_max(v)
    return F.when(hi == lo, v).otherwise(F.transform(v, lambda x: (x - lo) / (hi - lo)))


def merge_vectors(a: Column | str, b: Column | str) -> Column:
    """Mean of two vectors, re-normalised to unit length."""
    return normalise(F.zip_with(as_double(a), as_double(b), lambda x, y: (x + y) / 2.0))


def centroids(df: DataFrame, group: str, vec: str, out: str = "centroid") -> DataFrame:
    """Element-wise mean vector per group.

    Vectors are exploded to (group, position, value) and averaged with a
    partial aggregate, so a huge group is summed map-side; only
    ``dim`` values per group are regathered into the array.
    """
    e = df.select(group, F.posexplode(as_double(vec)).alias("_pos", "_x"))
    m = e.groupBy(group, "_pos").agg(F.avg("_x").alias("_m"))
    return m.groupBy(group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_m"))), lambda s: s["_m"]).alias(out))
