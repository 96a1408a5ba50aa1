"""Fronts and volumes of any number of maximised objectives.

* ``pareto_nd`` is an exact skyline without a merge in one task. Distinct points
  are dealt to a grid of cells whose edges are quantiles; a cell all of whose
  coordinates are smaller than those of some other non-empty cell holds no
  front point. What is left is thinned inside each task, packed into blocks of
  bounded size, and a block is compared only with the blocks of cells that can
  dominate it (an equi-join on cell numbers, with the corners of the blocks as a
  second test).
* ``hypervolume_3d`` sweeps the third axis: points are cut into slabs of bounded
  size, a slab starts from the 2-D front of everything above it and adds its own
  points one by one; the slabs' volumes are summed.

NULL or NaN in an objective keeps a point off the front and out of the volume.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cells of the grid over all objectives, at most.
CELLS = 512
#: Points of a block; also what a task keeps while it thins its points.
BLOCK = 2048
#: Points of a slab of the sweep.
SLAB = 50_000


def _dominated(points: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Which ``points`` some row of ``by`` dominates (at least as high in all
    objectives, higher in one)."""
    out = np.zeros(len(points), bool)
    step = max(1, 4_000_000 // max(1, by.size))
    for i in range(0, len(points), step):
        p = points[i:i + step, None, :]
        out[i:i + step] = ((by >= p).all(2) & (by > p).any(2)).any(1)
    return out


def _thin(names: Sequence[str]):
    """Drops points that another point of the same task dominates. The best
    points by sum are kept for comparison, ``BLOCK`` of them at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros((0, len(names)))
        for batch in batches:
            v = np.column_stack([batch.column(batch.schema.get_field_index(n)).to_numpy() for n in names])
            keep = ~_dominated(v, best)
            some = v[keep]
            some = some[np.argsort(-some.sum(1), kind="stable")[:BLOCK]]
            keep[keep] = ~_dominated(v[keep], some)
            yield batch.filter(pa.array(keep))
            best = np.concatenate([best, some])
            best = best[~_dominated(best, best)]
            best = best[np.argsort(-best.sum(1), kind="stable")[:BLOCK]]
    return run


def _flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joined blocks to the numbers of the points that are dominated."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            ids = row.column(0).flatten()
            points, by = (c.flatten().to_numpy().reshape(len(c.flatten()) // d, d) for c, d in (
                (row.column(1), len(row.column(1).flatten()) // len(ids)), (row.column(2), len(row.column(1).flatten()) // len(ids))))
            hit = _dominated(points, by)
            yield pa.RecordBatch.from_arrays([ids.filter(pa.array(hit))], ["_id"])


def front_nd(df: DataFrame, objectives: Sequence[str]) -> DataFrame:
    """The distinct non-dominated points of ``df``, one row each."""
    names = [f"_o{i}" for i in range(len(objectives))]
    pts = df.select(*[F.col(c).cast("double").alias(n) for c, n in zip(objectives, names)])
    for n in names:
        pts = pts.where(F.col(n).isNotNull() & ~F.isnan(n))
    pts = pts.distinct()
    bins = max(1, int(CELLS ** (1 / len(names)) + 1e-9))
    cuts = [[(i + 1) / bins for i in range(bins - 1)]] * len(names)
    edges = pts.agg(*[F.percentile_approx(n, c, 1000).alias(n) if c else F.lit(None).alias(n)
                      for n, c in zip(names, cuts)]).first()
    # the number of edges below a value: larger cell numbers mean larger values
    cell = F.concat_ws(",", *[F.coalesce(sum((F.when(F.col(n) > e, 1).otherwise(0) for e in sorted(set(edges[n] or []))), F.lit(0)),
                                         F.lit(0)).cast("string") for n in names])
    pts = pts.withColumn("_cell", cell).mapInArrow(_thin(names), ", ".join(f"{n} double" for n in names) + ", _cell string")
    pts = pts.withColumn("_id", F.monotonically_increasing_id()).checkpoint()  # numbers stay what they are
    sizes = {r["_cell"]: r["count"] for r in pts.groupBy("_cell").count().collect()}  # CELLS rows at most
    grid = np.array([[int(x) for x in c.split(",")] for c in sizes]).reshape(len(sizes), len(names))
    live = [c for c, at in zip(sizes, grid) if not (grid > at).all(1).any()]
    if not live:
        return pts.select(*[F.col(n).alias(c) for n, c in zip(names, objectives)])
    where = {c: np.array([int(x) for x in c.split(",")]) for c in live}
    spark = df.sparkSession
    reach = spark.createDataFrame([(a, b) for a in live for b in live if (where[b] >= where[a]).all()], "_cell string, _over string")
    blocks = spark.createDataFrame([(c, -(-sizes[c] // BLOCK)) for c in live], "_cell string, _n int")
    dealt = pts.join(F.broadcast(blocks), "_cell")  # cells: bounded by CELLS
    point = F.array(*names)
    packed = (dealt.groupBy("_cell", F.pmod(F.xxhash64("_id"), F.col("_n")).alias("_b"))
              .agg(F.collect_list("_id").alias("ids"), F.flatten(F.collect_list(point)).alias("points"),
                   *[F.min(n).alias(f"lo{n}") for n in names], *[F.max(n).alias(f"hi{n}") for n in names])).checkpoint()
    over = packed.select(F.col("_cell").alias("_over"), F.col("points").alias("by"), *[F.col(f"hi{n}").alias(f"top{n}") for n in names])
    pairs = packed.join(F.broadcast(reach), "_cell").join(over, "_over")
    for n in names:
        pairs = pairs.where(F.col(f"top{n}") >= F.col(f"lo{n}"))
    lost = pairs.select("ids", "points", "by").mapInArrow(_flags, "_id bigint").distinct()
    return (pts.join(F.broadcast(blocks.select("_cell")), "_cell", "left_semi").join(lost, "_id", "left_anti")
            .select(*[F.col(n).alias(c) for n, c in zip(names, objectives)]))


def pareto_nd(df: DataFrame, objectives: Sequence[str], out: str = "on_front") -> DataFrame:
    """``df`` with a mask of the non-dominated rows for any number of maximised
    objectives (equal rows all stay)."""
    front = front_nd(df, objectives).select(*[F.col(c).alias(f"_f_{i}") for i, c in enumerate(objectives)], F.lit(True).alias("_on"))
    same = [F.col(c).cast("double") == F.col(f"_f_{i}") for i, c in enumerate(objectives)]
    return df.join(front, same, "left").select(*df.columns, F.coalesce("_on", F.lit(False)).alias(out))


class _Stair:
    """A 2-D front as a staircase (x rising, y falling) and its area."""

    def __init__(self, x0: float, y0: float):
        self.x0, self.y0, self.x, self.y, self.area = x0, y0, [], [], 0.0

    def add(self, x: float, y: float) -> None:
        if x <= self.x0 or y <= self.y0:
            return
        i = bisect_left(self.x, x)
        if i < len(self.x) and self.y[i] >= y:
            return
        j = i + (i < len(self.x) and self.x[i] == x)  # a step at the same x is covered
        low = i
        while low > 0 and self.y[low - 1] <= y:
            low -= 1
        # area between the new corner and the steps it covers
        left, gained = (self.x[low - 1] if low else self.x0), 0.0
        for k in range(low, i):
            gained += (self.x[k] - left) * (y - self.y[k])
            left = self.x[k]
        below = self.y[i] if i < len(self.x) else self.y0
        self.area += gained + (x - left) * (y - below)
        self.x[low:j], self.y[low:j] = [x], [y]


def _slab_volume(ref: Sequence[float]):
    def run(key, points: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        stair = _Stair(ref[0], ref[1])
        for x, y in zip(above["x"], above["y"]):
            stair.add(x, y)
        volume, bottom = 0.0, float(points["_bottom"].iloc[0]) if len(points) else 0.0
        p = points.sort_values("z", ascending=False)
        z = p["z"].to_numpy()
        for i, (x, y) in enumerate(zip(p["x"], p["y"])):
            stair.add(x, y)
            volume += stair.area * (z[i] - (z[i + 1] if i + 1 < len(z) else bottom))
        return pd.DataFrame({"volume": [volume]})
    return run


def _slab_front(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The 2-D front of a slab's points: a point stays if its y is above all of
    those with a larger x."""
    frames = [b for b in batches if len(b)]
    if frames:
        p = pd.concat(frames).sort_values(["x", "y"], ascending=False)
        before = p["y"].cummax().shift(fill_value=-np.inf)
        yield p[p["y"] > before][["_slab", "x", "y"]]


def hypervolume_3d(points: DataFrame, x: str, y: str, z: str, ref: Sequence[float] = (0.0, 0.0, 0.0)) -> DataFrame:
    """Volume dominated by maximised 3-D points above ``ref``, exact."""
    p = points.select(*[F.col(c).cast("double").alias(n) for c, n in ((x, "x"), (y, "y"), (z, "z"))])
    for n, low in zip("xyz", ref):
        p = p.where(F.col(n) > F.lit(float(low)))  # NULL, and what adds no volume
    p = front_nd(p.where(~F.isnan("x") & ~F.isnan("y") & ~F.isnan("z")), ["x", "y", "z"])
    p = p.checkpoint()
    slabs = max(1, -(-p.count() // SLAB))
    p = p.repartitionByRange(slabs, F.col("z").desc()).withColumn("_slab", F.spark_partition_id()).checkpoint()
    # a slab ends where the next non-empty one begins, the last at the reference
    tops = sorted((r["_slab"], r["top"]) for r in p.groupBy("_slab").agg(F.max("z").alias("top")).collect())
    spark = points.sparkSession
    if not tops:
        return spark.createDataFrame([(0.0,)], "hypervolume double")
    bottom = spark.createDataFrame([(s, tops[i + 1][1] if i + 1 < len(tops) else float(ref[2])) for i, (s, _) in enumerate(tops)],
                                   "_slab int, _bottom double")
    number = F.col("_slab").cast("int")
    own = p.select(number.alias("_slab"), "x", "y", "z").join(F.broadcast(bottom), "_slab")  # a row per slab
    fronts = p.mapInPandas(_slab_front, "_slab int, x double, y double")
    above = fronts.join(F.broadcast(bottom.select(F.col("_slab").alias("_to"))), F.col("_to") > F.col("_slab")).select(
        F.col("_to").alias("_slab"), "x", "y")
    volumes = own.groupBy("_slab").cogroup(above.groupBy("_slab")).applyInPandas(_slab_volume(tuple(map(float, ref))), "volume double")
    return volumes.agg(F.coalesce(F.sum("volume"), F.lit(0.0)).alias("hypervolume"))
