"""Shared helpers: session preparation, shared scratch tables, word rules."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vialflow.session import ensure_checkpoint_dir, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: The six ASCII characters that separate words, as a Java / RE2 class body.
GAP_CLASS = r"\x20\x09-\x0D"
WORD = f"[^{GAP_CLASS}]+"
GAP = f"[{GAP_CLASS}]+"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Stands for a NULL document id wherever ids are ordered: before all others.
NULL_ID = -(1 << 63)


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` as a query of this package."""

    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def prepare(spark: SparkSession) -> None:
    """Make the package importable on executors and the shared folder usable."""
    ship_package(spark)
    ensure_checkpoint_dir(spark)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture table, read lazily so that column pruning reaches the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the folder that driver and executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it back.

    A lost executor then costs a re-read, never a recomputation of the steps
    before, and values such as row numbers stay what they were. Shuffle files
    of the finished write are dropped at once, as nothing reads them again.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def text_of(text_col: str) -> Column:
    """The text, a NULL read as empty."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def id_order(id_col: str) -> Column:
    """The id as a long that orders NULL before every other id."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID))


def tasks_for(df: DataFrame, default: int | None = None) -> int:
    """Shuffle width for keyed work; AQE merges what turns out small."""
    return default or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
