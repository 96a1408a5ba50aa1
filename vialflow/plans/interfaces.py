"""Sections A (sources and sinks) and P (user-function surface)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from vialflow.functions.stats import rnd
from vialflow.operators import udf as U
from vialflow.operators.mining import DEFAULT_RULES
from vialflow.plans.planning import _WL_SQL, _worklist, _stats, _STATS_SQL
from vialflow.plans.registry import register
from vialflow.session import scratch_path
from vialflow.sources import io
from vialflow.sources.tables import Tables

PART_SCHEMA = StructType([StructField("p_partkey", LongType()), StructField("p_name", StringType()),
                          StructField("p_brand", StringType()), StructField("p_type", StringType()),
                          StructField("p_size", IntegerType()), StructField("p_retailprice", DoubleType())])


@register("read_csv", sql="SELECT * FROM part")
def read_csv(spark, sf):
    """Part table written as ';'-separated CSV with decimal commas, then read
    back with the declared schema."""
    path = scratch_path(spark, "part-csv")
    io.write_csv(Tables(spark, sf).part, path, sep=";", decimal=",")
    return io.read_csv(spark, path, PART_SCHEMA, sep=";", decimal=",")


@register("write_csv", sql="SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def write_csv(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    path = scratch_path(spark, "orders-csv")
    io.write_csv(o, path)
    schema = StructType([StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
                         StructField("o_orderstatus", StringType()), StructField("o_totalprice", DoubleType()),
                         StructField("o_orderpriority", StringType())])
    return io.read_csv(spark, path, schema)


WORKLIST_COLUMNS = ["category", "stock", "plate", "well", "volume"]


@register("write_worklist", sql=f"SELECT category, stock, plate, well, volume FROM {_WL_SQL}")
def write_worklist(spark, sf):
    path = scratch_path(spark, "worklist")
    io.write_worklist(_worklist(spark, sf), path, WORKLIST_COLUMNS)
    schema = StructType([StructField("category", StringType()), StructField("stock", StringType()),
                         StructField("plate", LongType()), StructField("well", StringType()),
                         StructField("volume", DoubleType())])
    return io.read_csv(spark, path, schema, header=False)


@register("read_run_logs", sql="""
SELECT o_orderstatus AS run, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderstatus
""")
def read_run_logs(spark, sf):
    """Orders written as one CSV log folder per status (run), read back by
    glob and tagged with the run from each file's path."""
    base = scratch_path(spark, "runlogs")
    o = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("run"))
    o.write.mode("overwrite").option("header", True).partitionBy("run").csv(base)
    schema = StructType([StructField("o_orderkey", LongType()), StructField("o_totalprice", DoubleType())])
    logs = io.read_run_logs(spark, f"{base}/run=*/*.csv", schema, r"/run=([^/]+)/")
    return logs.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@register("save_load_space", sql="""
SELECT p_partkey, p_retailprice / p_size AS score FROM part
""")
def save_load_space(spark, sf):
    path = scratch_path(spark, "spaces")
    pa = Tables(spark, sf).part.select("p_partkey", (F.col("p_retailprice") / F.col("p_size")).alias("score"))
    io.save_space(pa, path, "run-1")
    io.save_space(pa.limit(0), path, "run-0")
    return io.load_space(spark, path, "run-1")


# ---------------------------------------------------------------- P
@register("map_struct", sql="""
SELECT event_id,
       CASE WHEN json_valid(props) THEN json_array_length(json_keys(props))::INTEGER END AS n_keys,
       TRY_CAST(json_extract(CASE WHEN json_valid(props) THEN props END, '$.k') AS DOUBLE) AS k
FROM events
""")
def map_struct(spark, sf):
    ev = Tables(spark, sf).events
    return ev.select("event_id", U.map_struct("props", U.json_summary, "n_keys int, k double").alias("s")).select(
        "event_id", "s.n_keys", "s.k")


@register("map_groups", sql=f"""
WITH s AS {_STATS_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY mean DESC, arm) AS rk,
             sum(pulls) OVER (PARTITION BY user_id) AS tot FROM s)
SELECT user_id, arm AS best_arm, pulls, round(pulls / tot, 6) AS pull_share FROM r WHERE rk = 1
""")
def map_groups(spark, sf):
    st = _stats(spark, sf).select("user_id", "arm", "pulls", "mean")
    g = U.map_groups(st, "user_id", U.arm_summary, "user_id long, best_arm string, pulls long, pull_share double")
    return g.select("user_id", "best_arm", "pulls", rnd("pull_share").alias("pull_share"))


_CUE = [p for k, _n, p in DEFAULT_RULES if k == "strong"][0]


@register("infer_batch", sql=f"""
SELECT doc_id, CASE WHEN contains(text, '{_CUE}') THEN 'Y' || chr(10) || 'Rationale: contains ''{_CUE}'''
                    ELSE 'N' || chr(10) || 'Rationale: no cue' END AS raw, NULL::VARCHAR AS error
FROM documents
""")
def infer_batch(spark, sf):
    """Rule-based client over every document (latency is measured but not
    part of the compared output)."""
    d = Tables(spark, sf).documents.select("doc_id", "text")
    return U.infer(d, "doc_id", "text").select("doc_id", "raw", "error")


@register("explode_udtf", sql="""
SELECT p_partkey, step::INTEGER AS step, p_name || '#' || step::VARCHAR AS component, round(p_retailprice / ((p_size % 4) + 1), 6) AS volume
FROM part, LATERAL (SELECT unnest(range(0, (p_size % 4) + 1)) AS step)
""")
def explode_udtf(spark, sf):
    pa = Tables(spark, sf).part
    n = (F.col("p_size") % 4 + 1).cast("int")
    out = pa.lateralJoin(U.TransferRows(F.col("p_name").outer(), n.outer(), F.col("p_retailprice").outer()))
    return out.select("p_partkey", "step", "component", rnd("volume").alias("volume"))


@register("front_agg", sql="""
WITH r AS (SELECT l_returnflag AS g, l_quantity / 50.0 AS x, 1.0 - l_discount * 5.0 AS y FROM lineitem),
px AS (SELECT g, x, max(y) AS v FROM r GROUP BY g, x),
st AS (SELECT g, x, v, max(v) OVER (PARTITION BY g ORDER BY x DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS strict FROM px),
f AS (SELECT r.g, r.x, r.y FROM r JOIN st USING (g, x) WHERE NOT ((st.strict IS NOT NULL AND st.strict >= r.y) OR st.v > r.y)),
o AS (SELECT g, x, max(y) OVER (PARTITION BY g ORDER BY x DESC, y DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS env,
             coalesce(lead(x) OVER (PARTITION BY g ORDER BY x DESC, y DESC), 0.0) AS nx FROM f)
SELECT g AS l_returnflag, count(*) AS n_front, round(sum(greatest(0.0, x - nx) * greatest(0.0, env)), 6) AS hypervolume
FROM o GROUP BY g
""")
def front_agg(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_returnflag", (F.col("l_quantity") / 50.0).alias("x"),
                                           (F.lit(1.0) - F.col("l_discount") * 5.0).alias("y"))
    f = U.front_agg(li, "l_returnflag", "x", "y")
    return f.select("l_returnflag", "n_front", rnd("hypervolume").alias("hypervolume"))
