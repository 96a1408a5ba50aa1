"""Nearest rows by a grid index with widening rings.

Pool points are dealt to a grid whose edges are quantiles of each feature. A
proposal first meets the points of its own cell and the cells around it. Its
answer is final once the best distance is smaller than the way to the border of
the cells it has seen; only other proposals go on: to every cell that a point as
near as the best one can lie in, or, having met no point yet, to a ring twice as
wide. Most proposals take one round, the others one more after their first hit.

No product of tables is built: rows are joined by cell number, and a cell farther
away than the best distance makes no row. Equal pool points count once (their
smallest id answers), as do equal proposals, so copies do not fill a cell.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vialflow.session import scratch_path

#: Pool points per cell that the grid aims at, and cells of the grid at most.
PER_CELL, CELLS = 32, 1_000_000


class Grid:
    """Edges per feature; a value's cell is the number of edges at or below it."""

    def __init__(self, edges: Sequence[np.ndarray]):
        self.edges = [np.asarray(e, float) for e in edges]
        self.step = np.cumprod([1, *(len(e) + 1 for e in self.edges[:-1])])

    def number(self, points: np.ndarray) -> np.ndarray:
        return sum(np.searchsorted(e, points[:, i], "right") * s for i, (e, s) in enumerate(zip(self.edges, self.step)))

    def _cells(self, spans: Sequence[np.ndarray], keep=None) -> list[int]:
        grids = np.meshgrid(*spans, indexing="ij")
        numbers = sum(g * s for g, s in zip(grids, self.step)).ravel()
        return (numbers if keep is None else numbers[keep]).tolist()

    def ring(self, point: np.ndarray, width: int) -> list[int]:
        """Cells at most ``width`` steps away in every feature."""
        at = [int(np.searchsorted(e, x, "right")) for e, x in zip(self.edges, point)]
        return self._cells([np.arange(max(0, a - width), min(len(e), a + width) + 1) for a, e in zip(at, self.edges)])

    def border(self, point: np.ndarray, width: int) -> float:
        """Way from the point to what lies outside of that ring."""
        ways = [np.inf]
        for e, x in zip(self.edges, point):
            at = int(np.searchsorted(e, x, "right"))
            ways += ([x - e[at - width - 1]] if at - width - 1 >= 0 else []) + ([e[at + width] - x] if at + width < len(e) else [])
        return float(min(ways))

    def within(self, point: np.ndarray, distance: float) -> list[int]:
        """Cells that reach into the ball around the point."""
        reach = distance * (1 + 1e-9) + 1e-300
        spans, far = [], []
        for e, x in zip(self.edges, point):
            cells = np.arange(np.searchsorted(e, x - reach, "right"), np.searchsorted(e, x + reach, "right") + 1)
            low, high = np.concatenate([[-np.inf], e])[cells], np.concatenate([e, [np.inf]])[cells]
            spans.append(cells)
            far.append(np.maximum(np.maximum(low - x, x - high), 0.0) ** 2)
        total = sum(np.meshgrid(*far, indexing="ij")).ravel()
        return self._cells(spans, total <= reach * reach)


def nearest(props: DataFrame, pool: DataFrame, feats: Sequence[str], prop_id: str, pool_id: str) -> DataFrame:
    """``prop_id, pool_id, distance``: the nearest pool row (Euclidean over
    ``feats``) to every proposal; ties go to the smallest pool id. Rows with a
    NULL or non-finite feature take no part; an empty pool gives no rows."""
    spark = props.sparkSession
    names, d = [f"_x{i}" for i in range(len(feats))], len(feats)

    def points(df: DataFrame, key: str, alias: str) -> DataFrame:
        out = df.select(F.col(key).alias(alias), *[F.col(f).cast("double").alias(n) for f, n in zip(feats, names)])
        for n in names:
            out = out.where(F.col(n).isNotNull() & (F.abs(n) < float("inf")) & ~F.isnan(n))
        return out
    ask = points(props, prop_id, "_ask")
    have = points(pool, pool_id, "_have").groupBy(*names).agg(F.min("_have").alias("_have"))
    n = have.count()
    bins = max(1, int(min(CELLS, n / PER_CELL) ** (1 / d)))
    cuts = [(i + 1) / bins for i in range(bins - 1)]
    found = have.agg(*[F.percentile_approx(c, cuts, 10_000).alias(c) for c in names]).first() if cuts and n else {}
    grid = Grid([sorted(set(found[c] or [])) if found else [] for c in names])  # CELLS bounds their product

    @F.pandas_udf("long")
    def number(*cols: pd.Series) -> pd.Series:
        return pd.Series(grid.number(np.column_stack(cols))) if len(cols[0]) else pd.Series([], dtype="int64")

    def cells_of(width: int):
        @F.pandas_udf("array<bigint>")
        def cells(best: pd.Series, *cols: pd.Series) -> pd.Series:
            p = np.column_stack(cols)
            return pd.Series([grid.ring(x, width) if np.isnan(b) else grid.within(x, b) for x, b in zip(p, best)], dtype=object)
        return cells

    @F.pandas_udf("double")
    def border(*cols: pd.Series) -> pd.Series:
        return pd.Series([grid.border(x, 1) for x in np.column_stack(cols)], dtype=float)
    have = have.withColumn("_cell", number(*names)).select("_cell", "_have", *[F.col(c).alias(f"_h{c}") for c in names])
    have = have.checkpoint()
    todo = ask.select(*names).distinct().withColumn("_best", F.lit(float("nan")))
    path, width, kind = scratch_path(spark, "nearest"), 1, pool.schema[pool_id].dataType
    rounds, widest = 0, max(len(e) for e in grid.edges) + 1
    while True:
        spread = todo.withColumn("_cell", F.explode(cells_of(width)("_best", *names)))
        d2 = sum(((F.col(f"_h{c}") - F.col(c)) ** 2 for c in names), F.lit(0.0))
        met = (spread.join(have, "_cell").withColumn("_d2", d2).groupBy(*names).agg(
            F.min_by("_have", F.struct("_d2", "_have")).alias("_have"), F.sqrt(F.min("_d2")).alias("_new")))
        now = todo.join(met, names, "left")
        # a search around a known distance is final; so is a first ring whose border is farther than its best point
        done = F.col("_new").isNotNull() & (~F.isnan("_best") | ((F.col("_new") < border(*names)) if width == 1 else F.lit(False)))
        now = now.withColumn("_done", done).checkpoint()
        now.where("_done").select(*names, "_have", F.col("_new").alias("_far")).write.parquet(f"{path}/{rounds}")
        todo = now.where("not _done").select(*names, F.coalesce("_new", F.lit(float("nan"))).alias("_best"))
        rounds, width = rounds + 1, width * 2
        if todo.isEmpty() or (width > 2 * widest and todo.where(~F.isnan("_best")).isEmpty()):
            break
    schema = ask.select(*names).withColumn("_have", F.lit(None).cast(kind)).withColumn("_far", F.lit(None).cast("double")).schema
    answers = spark.read.schema(schema).parquet(f"{path}/*")
    return ask.join(answers, names).select(F.col("_ask").alias(prop_id), F.col("_have").alias(pool_id), F.col("_far").alias("distance"))
