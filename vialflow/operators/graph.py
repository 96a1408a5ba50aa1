"""Graph jobs on edge tables: directed expansion and degree, neighbour
aggregation, iterated message passing, pooling and grid shortest paths.

Graphs are two tables - nodes(node_id, x) and edges(src, dst, w) - so every
step is a join plus a grouped aggregate: a hub node's messages are combined
map-side (partial aggregation) and AQE splits a skewed join partition.
Iterations cut their lineage with ``checkpoint()`` into the cluster's
shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vialflow.session import ensure_checkpoint_dir, scratch_path, written


def expand_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Undirected edge list -> both directions, without duplicates."""
    e = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"))
    return e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


def degree(directed: DataFrame) -> DataFrame:
    return directed.groupBy(F.col("src").alias("node_id")).agg(F.count(F.lit(1)).alias("degree"))


def aggregate_neighbours(nodes: DataFrame, edges: DataFrame, how: str = "mean", weight: str | None = None,
                         inverse: bool = False) -> DataFrame:
    """For every destination node: mean or sum of its in-neighbours' ``x``,
    optionally weighted by the edge weight (or its inverse, weights below
    1e-6 read as that). A weighted mean divides by the number of in-edges."""
    j = edges.join(nodes.select(F.col("node_id").alias("src"), "x"), "src")
    w = F.lit(1.0)
    if weight:
        w = (F.lit(1.0) / F.greatest(F.col(weight), F.lit(1e-6))) if inverse else F.col(weight)
    if how == "sum":
        a = F.sum(F.col("x") * w)
    elif how == "mean":
        a = F.avg(F.col("x") * w)
    else:
        raise ValueError(how)
    return j.groupBy(F.col("dst").alias("node_id")).agg(a.alias("agg"))


def _mean_vectors(nodes: DataFrame, edges: DataFrame, width: int, how: str = "mean", plus: str | None = None) -> DataFrame:
    """``node_id, agg``: element-wise mean or sum of the in-neighbours' vectors
    (plus the edge's own vector ``plus``). One partial aggregate per element, so
    a hub's messages are combined before the shuffle and never exploded."""
    j = edges.join(nodes.select(F.col("node_id").alias("src"), "x"), "src")
    fn = F.avg if how == "mean" else F.sum
    each = [F.get("x", F.lit(i)) + (F.get(plus, F.lit(i)) if plus else F.lit(0.0)) for i in range(width)]
    g = j.groupBy(F.col("dst").alias("node_id")).agg(*[fn(e).alias(f"_{i}") for i, e in enumerate(each)])
    return g.select("node_id", F.array(*[F.col(f"_{i}") for i in range(width)]).alias("agg"))


def _width(nodes: DataFrame) -> int:
    return nodes.select(F.max(F.size("x"))).first()[0] or 0


def message_pass(nodes: DataFrame, edges: DataFrame, steps: int, a: float, b: float, cap: float | None = 2.0,
                 checkpoint_every: int = 2) -> DataFrame:
    """``x <- tanh(a * x + b * mean_in_neighbours(x))`` repeated ``steps`` times
    (nodes without in-neighbours use 0). ``x`` is a number or a vector; with
    ``cap`` a vector longer than that is scaled back to it (a number cannot be:
    tanh stays below 1). Lineage is cut every ``checkpoint_every`` steps with a
    reliable checkpoint."""
    vector = nodes.schema["x"].dataType.typeName() == "array"
    cur = nodes.select("node_id", F.col("x").cast("array<double>" if vector else "double").alias("x"))
    width = _width(cur) if vector else 0
    if checkpoint_every:
        ensure_checkpoint_dir(nodes.sparkSession)
    step = lambda x, m: F.tanh(F.lit(a) * x + F.lit(b) * F.coalesce(m, F.lit(0.0)))
    for i in range(steps):
        if vector:
            j = cur.join(_mean_vectors(cur, edges, width), "node_id", "left")
            nxt = j.select("node_id", F.array(*[step(F.get("x", F.lit(k)), F.get("agg", F.lit(k))) for k in range(width)]).alias("x"))
            if cap is not None:
                norm = F.sqrt(sum((F.get("x", F.lit(k)) ** 2 for k in range(width)), F.lit(0.0)))
                nxt = nxt.withColumn("_s", F.least(F.lit(1.0), F.lit(float(cap)) / F.greatest(norm, F.lit(1e-8)))).select(
                    "node_id", F.transform("x", lambda v: v * F.col("_s")).alias("x"))
        else:
            j = cur.join(aggregate_neighbours(cur, edges, "mean"), "node_id", "left")
            nxt = j.select("node_id", step(F.col("x"), F.col("agg")).alias("x"))
        if checkpoint_every and (i + 1) % checkpoint_every == 0 and i + 1 < steps:
            nxt = nxt.checkpoint(eager=True)
        cur = nxt
    return cur


def typed_message(nodes: DataFrame, edges: DataFrame, w_self: Sequence[Sequence[float]], w_nei: Sequence[Sequence[float]],
                  emb: DataFrame) -> DataFrame:
    """One step ``relu(W_self x + sum over in-edges of W_nei (x_src + e_type))``
    with given weights. ``nodes``: node_id, x (a vector as long as the rows of the
    weights); ``edges``: src, dst, type; ``emb``: type, e. The sum is taken before
    the product, which is the same and moves ``len(x)`` numbers per edge only in
    partial sums. An edge of an unknown type adds nothing for its type."""
    width = len(w_self[0])
    typed = edges.select("src", "dst", "type").join(emb.select("type", "e"), "type", "left").withColumn(
        "e", F.coalesce("e", F.array(*[F.lit(0.0)] * width)))
    agg = _mean_vectors(nodes, typed, width, "sum", plus="e")
    j = nodes.select("node_id", "x").join(agg, "node_id", "left")

    def row(w: Sequence[float], col: str):
        return sum((F.lit(float(v)) * F.coalesce(F.get(col, F.lit(k)), F.lit(0.0)) for k, v in enumerate(w)), F.lit(0.0))
    return j.select("node_id", F.array(*[F.greatest(F.lit(0.0), row(s, "x") + row(n, "agg")) for s, n in zip(w_self, w_nei)]).alias("x"))


def pool(nodes: DataFrame, by: str, how: str = "mean") -> DataFrame:
    """Graph read-out: mean or sum of node features (numbers or vectors) per graph."""
    fn = F.avg if how == "mean" else F.sum
    n = F.count(F.lit(1)).alias("n_nodes")
    if nodes.schema["x"].dataType.typeName() != "array":
        return nodes.groupBy(by).agg(fn("x").alias("pooled"), n)
    width = _width(nodes)
    g = nodes.groupBy(by).agg(*[fn(F.get("x", F.lit(k)).cast("double")).alias(f"_{k}") for k in range(width)], n)
    return g.select(by, F.array(*[F.col(f"_{k}") for k in range(width)]).alias("pooled"), "n_nodes")


def distances(edges: DataFrame, source) -> DataFrame:
    """``node_id, d``: steps from ``source`` to every node that undirected
    ``edges`` (src, dst) reach. A neighbour of a node at distance d lies at d - 1,
    d or d + 1, so a round joins the frontier with the edges and drops the two
    last levels; each level is written once and never again, until one is empty."""
    spark = edges.sparkSession
    e = written(expand_edges(edges), "bfs-edges")
    path, level = scratch_path(spark, "bfs-levels"), 0
    frontier = e.where(F.col("src") == source).select(F.col("src").alias("node_id")).limit(1)
    before = frontier.where("1 = 0")
    schema = frontier.withColumn("d", F.lit(0)).schema
    while True:
        frontier.withColumn("d", F.lit(level)).write.parquet(f"{path}/{level}")
        now = spark.read.schema(schema).parquet(f"{path}/{level}").select("node_id")
        if now.isEmpty():
            break
        frontier = (now.join(e, now["node_id"] == e["src"]).select(F.col("dst").alias("node_id")).distinct()
                    .join(now, "node_id", "left_anti").join(before, "node_id", "left_anti"))
        before, level = now, level + 1
    return spark.read.schema(schema).parquet(f"{path}/*")


def grid_shortest_path(cells: DataFrame, source: tuple[int, int]) -> DataFrame:
    """``x, y, d``: steps on a 4-neighbour grid of open cells (cells(x, y));
    unreachable cells are absent."""
    at = lambda x, y: F.concat_ws(",", x.cast("string"), y.cast("string"))
    c = cells.select("x", "y").distinct()
    x, y = F.col("x"), F.col("y")
    here = c.select(at(x, y).alias("src"), F.explode(F.array(at(x + 1, y), at(x, y + 1), at(x, y))).alias("dst"))
    edges = here.join(c.select(at(x, y).alias("dst")), "dst", "left_semi").select("src", "dst")
    d = distances(edges, f"{source[0]},{source[1]}")
    part = F.split("node_id", ",")
    kinds = dict(cells.dtypes)
    return d.select(part[0].cast(kinds["x"]).alias("x"), part[1].cast(kinds["y"]).alias("y"), "d")
