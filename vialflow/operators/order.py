"""Sorts, limits and top-k picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialflow.operators.window import RANGE, exact_quantiles, row_index


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sort(df: DataFrame, keys: Sequence, block: Column | str = RANGE, rank_col: str = "rank") -> DataFrame:
    """Multi-key sort with mixed directions plus a 1-based ``rank`` column so
    the order survives an order-insensitive comparison. The rank is a
    distributed running count (see ``window.running``)."""
    r = row_index(df, [_c(k) for k in keys], block, out="_idx")
    return r.withColumn(rank_col, F.col("_idx") + 1).drop("_idx").orderBy(rank_col)


def topn(df: DataFrame, col: str, n: int, id_cols) -> DataFrame:
    """Top ``n`` rows by ``col`` (desc), ids ascending on ties: TakeOrdered keeps
    a bounded heap per partition."""
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    return df.orderBy(F.col(col).desc_nulls_last(), *[F.col(i).asc() for i in ids]).limit(n)


def pick_batch(space: DataFrame, score: str, b: int, id_col: str, iteration: str = "iteration") -> DataFrame:
    """Mark the best ``b`` untested rows (iteration == -1) by score (desc, id
    asc) with the next iteration number; the batch (b rows) is broadcast back."""
    nxt = space.agg(F.coalesce(F.max(iteration), F.lit(-1)) + 1).scalar()
    batch = (space.where(F.col(iteration) == -1).where(F.col(score).isNotNull())
             .orderBy(F.col(score).desc(), F.col(id_col).asc()).limit(b)
             .select(id_col, F.lit(True).alias("_picked")))
    j = space.join(F.broadcast(batch), id_col, "left")
    return j.select(*[F.when(F.col("_picked"), nxt).otherwise(F.col(iteration)).cast("int").alias(iteration)
                      if c == iteration else F.col(c) for c in space.columns])


def pick_quantile(df: DataFrame, score: str, q: float) -> DataFrame:
    """Rows whose score is at or above the (1 - q) quantile (exact, linear)."""
    thr = exact_quantiles(df, score, (1.0 - q,)).select(F.col("_q")[0]).scalar()
    return df.where(F.col(score) >= thr)
