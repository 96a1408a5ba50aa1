"""Fixture table access.

Tables are read lazily from parquet so Catalyst can prune columns and push
filters into the scan; nothing is cached here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events "
          "documents embeddings pages benchmark labels conversations").split()


# Tables whose rows carry whole texts: per-row work on them (regexes, n-gram
# hashing, tokenising) dominates, so their scans must use every core.
TEXT_TABLES = {"documents", "pages", "conversations"}


def spread(df: DataFrame) -> DataFrame:
    """Scan-parallelism guard: when a scan yields fewer partitions than the
    cluster's default parallelism (e.g. one large row group), redistribute
    round-robin. On a cluster reading many files it is a no-op."""
    want = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(name)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


class Tables:
    """Attribute access to the fixture tables: ``t.lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return table(self._spark, self._dir, name)
