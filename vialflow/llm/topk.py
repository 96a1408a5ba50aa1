"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors become sparse integer rows: a dimension is a term, its component
floor(scale * x) the weight. Candidates are dealt into blocks and stored by
term, so a block holds one dense posting array per dimension. A block of
queries is scored against a block of candidates one term at a time: the
posting array, times each query's weight for that term, is added to dense
score arrays (terms whose weight is 0 in every query are skipped). The k best
of a block come from a partition selection; the blocks' winners are merged by
a window that keeps k rows per query before and after the shuffle.

Both sides are dealt into blocks of bounded size, and a task holds one pair of
blocks at a time. Nothing is broadcast; every query meets every candidate.

Defined cases: a vector that is NULL, empty or holds a NULL or non-finite
component takes no part, as query or candidate; shorter vectors count as
padded with zeros; ties go to the smaller id (NULL ids last); a candidate with
the query's id is the query's own row; query rows that repeat an id and a
vector are one query; fewer than k candidates give fewer rows; an empty table
gives no rows. Scores are exact 64-bit integers; sums beyond that range are
clipped to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vialflow.llm.common import materialise, prepare, read, register

SCALE = 1024
CANDIDATES_PER_BLOCK = 4096
QUERIES_PER_BLOCK = 256
_OUT = "_query bigint, query_id bigint, vec_id bigint, score bigint"


def quantise(vec: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) per component as longs; NULL where the vector takes no part."""
    v = vec.cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(v.isNotNull() & (F.size(v) > 0) & ~bad, F.transform(v, lambda x: F.floor(x * float(scale)).cast("long")))


def _matrix(rows, dims: int) -> np.ndarray:
    """Posting arrays: one row per dimension, one column per vector."""
    out = np.zeros((dims, len(rows)), np.int64)
    for j, r in enumerate(rows):
        out[:len(r), j] = r
    return out


def _accumulate(weights: np.ndarray, postings: np.ndarray) -> np.ndarray:
    """Scores of all queries (columns of ``weights``), one term at a time."""
    bound = float(np.abs(weights).max(initial=0)) * float(np.abs(postings).max(initial=0)) * len(weights)
    kind = np.float64 if bound < 2.0 ** 53 else np.int64 if bound < 2.0 ** 62 else object
    scores = np.zeros((weights.shape[1], postings.shape[1]), kind)
    for term in range(len(weights)):
        w = weights[term]
        used = np.flatnonzero(w)
        if len(used):
            scores[used] += w[used].astype(kind)[:, None] * postings[term].astype(kind)[None, :]
    return scores if kind is not object else np.clip(scores, -(1 << 63), (1 << 63) - 1)


def _select(score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties by position (ids are ascending)."""
    if len(score) <= k:
        return np.arange(len(score))
    edge = np.partition(score, len(score) - k)[len(score) - k]
    above = np.flatnonzero(score > edge)
    return np.concatenate([above, np.flatnonzero(score == edge)[:k - len(above)]])


def _scorer(k: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                cand = sorted(row["cands"], key=lambda c: (c["id"] is None, c["id"] or 0))
                queries = row["queries"]
                dims = max(len(x["v"]) for x in (*cand, *queries))
                scores = _accumulate(_matrix([q["v"] for q in queries], dims), _matrix([c["v"] for c in cand], dims))
                ids = np.array([np.iinfo(np.int64).max if c["id"] is None else c["id"] for c in cand], np.int64)
                null = np.array([c["id"] is None for c in cand])
                out: list[list] = [[], [], [], []]
                for q, s in zip(queries, scores):
                    other = np.flatnonzero((ids != q["id"]) | null)
                    for i in other[_select(s[other], k)]:
                        for column, value in zip(out, (q["key"], q["id"], cand[i]["id"], int(s[i]))):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                                 ["_query", "query_id", "vec_id", "score"])
    return score


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
          vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best candidates of each query."""
    row = F.monotonically_increasing_id()
    cand = vectors.select(F.col(id_col).cast("long").alias("id"), quantise(F.col(vec_col), scale).alias("v")) \
        .where("v is not null").withColumn("key", row)
    ask = queries.select(F.col(id_col).cast("long").alias("id"), quantise(F.col(vec_col), scale).alias("v")) \
        .where("v is not null").distinct().withColumn("key", row)
    # row numbers are fixed by writing them; blocks are then the same on a retry
    cand, ask = materialise(cand, "topk-candidates"), materialise(ask, "topk-queries")
    blocks = [max(1, -(-t.count() // per)) for t, per in ((cand, CANDIDATES_PER_BLOCK), (ask, QUERIES_PER_BLOCK))]
    pack = F.collect_list(F.struct("key", "id", "v"))
    cand = cand.groupBy(F.pmod("key", F.lit(blocks[0])).alias("_c")).agg(pack.alias("cands"))
    ask = ask.groupBy(F.pmod("key", F.lit(blocks[1])).alias("_q")).agg(pack.alias("queries"))
    pairs = (cand.withColumn("_q", F.explode(F.sequence(F.lit(0), F.lit(blocks[1] - 1))))
             .join(ask, "_q").select("queries", "cands"))
    found = pairs.mapInArrow(_scorer(k), _OUT)
    best = Window.partitionBy("_query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


@register("op9_topk_search", """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.e::double[], c.e::double[])::bigint as score
  from v q, v c where q.vec_id % 100 = 0 and q.vec_id <> c.vec_id)
select query_id, cast(row_number() over w as int) as rank, vec_id, score from scored
window w as (partition by query_id order by score desc, vec_id)
qualify row_number() over w <= 10
""")
def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best neighbours of every vector whose id is divisible by 100."""
    prepare(spark)
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))
