"""Set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append(a: DataFrame, b: DataFrame) -> DataFrame:
    """Append rows by column name (missing columns become NULL)."""
    return a.unionByName(b, allowMissingColumns=True)


def distinct_conditions(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).dropDuplicates()


def shared_conditions(df: DataFrame, entity: str, cols: Sequence[str], k: int) -> DataFrame:
    """Condition tuples observed for at least ``k`` distinct entities. The
    (condition, entity) pairs are de-duplicated map-side first, so a hot
    condition never ships its raw rows."""
    pairs = df.select(*cols, entity).where(F.col(entity).isNotNull()).dropDuplicates()
    return (pairs.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_entities"))
            .where(F.col("n_entities") >= k))


def difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct ids in ``a`` that are not in ``b`` (anti join on the id)."""
    return a.select(key).distinct().join(b.select(key), key, "left_anti")


def undirected(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Collapse directed edges to unique undirected pairs (u <= v)."""
    return edges.select(F.least(src, dst).alias("u"), F.greatest(src, dst).alias("v")).dropDuplicates()
