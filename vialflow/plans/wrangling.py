"""Sections B (cleaning), F (sorts, picks) and G (set operations)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from vialflow.functions.hashing import md5_unit
from vialflow.operators import clean, order, sets
from vialflow.plans.registry import register
from vialflow.plans.standins import CONDS, RUNS_SQL, runs
from vialflow.sources.tables import Tables

# ---------------------------------------------------------------- B


@register("select_columns", sql="SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def select_columns(spark, sf):
    return clean.select(Tables(spark, sf).lineitem, ["l_orderkey", "l_linenumber", "l_quantity"])


@register("where_filter", sql="""
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_discount > 0.05 AND l_returnflag = 'R'
""")
def where_filter(spark, sf):
    li = Tables(spark, sf).lineitem
    return clean.where(li, (F.col("l_discount") > 0.05) & (F.col("l_returnflag") == "R"),
                       ["l_orderkey", "l_linenumber", "l_extendedprice"])


@register("slice_rows", sql="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 10
""")
def slice_rows(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice")
    return clean.slice_rows(o, [F.col("o_totalprice").desc(), "o_orderkey"], 10, 20)


@register("ratio_to_reference", sql="""
SELECT p_partkey, p_retailprice,
       round(p_retailprice / (SELECT p_retailprice FROM part WHERE p_name = 'red widget'
                              ORDER BY p_partkey LIMIT 1), 6) AS ratio
FROM part
""")
def ratio_to_reference(spark, sf):
    pa = Tables(spark, sf).part.select("p_partkey", "p_name", "p_retailprice")
    r = clean.ratio_to_reference(pa, "p_retailprice", F.col("p_name") == "red widget", ["p_partkey"])
    return r.select("p_partkey", "p_retailprice", "ratio")


@register("clean_range", sql="""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity BETWEEN 5 AND 45
""")
def clean_range(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return clean.clean_range(li, "l_quantity", 5, 45)


# Customer table with NULLs injected by a hash of the key (the fixtures have
# none). Same rule in SQL below.
def _cu_nulls(spark, sf):
    cu = Tables(spark, sf).customer
    return cu.select(
        "c_custkey",
        F.when(md5_unit("c_custkey", "name") < 0.02, None).otherwise(F.col("c_name")).alias("c_name"),
        "c_nationkey",
        F.when(md5_unit("c_custkey", "bal") < 0.10, None).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.when(md5_unit("c_custkey", "seg") < 0.05, None).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))


def _u(key, seed):
    return f"(('0x' || substr(md5(concat({key}::VARCHAR, ':', '{seed}')), 1, 8))::UBIGINT / 4294967296.0)"


_CU_NULLS_SQL = f"""(SELECT c_custkey,
  CASE WHEN {_u('c_custkey', 'name')} < 0.02 THEN NULL ELSE c_name END AS c_name, c_nationkey,
  CASE WHEN {_u('c_custkey', 'bal')} < 0.10 THEN NULL ELSE c_acctbal END AS c_acctbal,
  CASE WHEN {_u('c_custkey', 'seg')} < 0.05 THEN NULL ELSE c_mktsegment END AS c_mktsegment
  FROM customer)"""


@register("null_counts", sql=f"""
WITH c AS {_CU_NULLS_SQL}
SELECT 'c_custkey' AS "column", count(*) FILTER (WHERE c_custkey IS NULL) AS n_null FROM c
UNION ALL SELECT 'c_name', count(*) FILTER (WHERE c_name IS NULL) FROM c
UNION ALL SELECT 'c_nationkey', count(*) FILTER (WHERE c_nationkey IS NULL) FROM c
UNION ALL SELECT 'c_acctbal', count(*) FILTER (WHERE c_acctbal IS NULL) FROM c
UNION ALL SELECT 'c_mktsegment', count(*) FILTER (WHERE c_mktsegment IS NULL) FROM c
""")
def null_counts(spark, sf):
    return clean.null_counts(_cu_nulls(spark, sf))


@register("fill_mean", sql=f"""
WITH c AS {_CU_NULLS_SQL}
SELECT c_custkey, round(coalesce(c_acctbal, (SELECT avg(c_acctbal) FROM c)), 6) AS c_acctbal FROM c
""")
def fill_mean(spark, sf):
    f = clean.fill_mean(_cu_nulls(spark, sf), ["c_acctbal"])
    return f.select("c_custkey", F.round("c_acctbal", 6).alias("c_acctbal"))


@register("drop_incomplete", sql=f"""
WITH c AS {_CU_NULLS_SQL}
SELECT c_custkey FROM c WHERE c_acctbal IS NOT NULL AND c_mktsegment IS NOT NULL
""")
def drop_incomplete(spark, sf):
    return clean.drop_incomplete(_cu_nulls(spark, sf), ["c_acctbal", "c_mktsegment"]).select("c_custkey")


@register("drop_all_null", sql="""
WITH d AS (SELECT d.doc_id, l.quality, l.toxic, CASE WHEN d.lang = 'en' THEN d.source END AS source
           FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT quality, toxic, source, count(*) AS n FROM d WHERE quality IS NOT NULL OR toxic IS NOT NULL OR source IS NOT NULL GROUP BY ALL
""")
def drop_all_null(spark, sf):
    """Documents without a label in another language than English have no value left."""
    t = Tables(spark, sf)
    d = t.documents.select("doc_id", F.when(F.col("lang") == "en", F.col("source")).alias("source")).join(t.labels, "doc_id", "left")
    return clean.drop_all_null(d.select("quality", "toxic", "source")).groupBy("quality", "toxic", "source").agg(F.count(F.lit(1)).alias("n"))


@register("finite_only", sql="""
SELECT l_orderkey, l_linenumber FROM (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_discount = 0 THEN 'inf'::DOUBLE ELSE l_extendedprice / l_discount END AS f1,
         CASE WHEN l_tax = 0 THEN 'nan'::DOUBLE ELSE l_quantity / l_tax END AS f2
  FROM lineitem) WHERE isfinite(f1) AND isfinite(f2)
""")
def finite_only(spark, sf):
    li = Tables(spark, sf).lineitem
    feats = li.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_discount") == 0, F.lit(math.inf))
        .otherwise(F.col("l_extendedprice") / F.col("l_discount")).alias("f1"),
        F.when(F.col("l_tax") == 0, F.lit(math.nan)).otherwise(F.col("l_quantity") / F.col("l_tax")).alias("f2"))
    return clean.finite_only(feats, ["f1", "f2"]).select("l_orderkey", "l_linenumber")


# Label map used by the encoding example.
EVENT_LABELS = {"view": 0, "click": 1, "purchase": 2}


@register("encode_label", sql="""
SELECT event_id, CASE replace(lower(trim(event_type)), '-', '_')
  WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 END AS label FROM events
""")
def encode_label(spark, sf):
    ev = Tables(spark, sf).events
    return ev.select("event_id", clean.encode_label("event_type", EVENT_LABELS).alias("label"))


@register("cut_bins", sql="""
SELECT l_orderkey, l_linenumber, CASE
  WHEN l_quantity >= '-inf'::DOUBLE AND l_quantity <= 10 THEN 0
  WHEN l_quantity > 10 AND l_quantity <= 25 THEN 1
  WHEN l_quantity > 25 AND l_quantity <= 40 THEN 2
  WHEN l_quantity > 40 AND l_quantity <= 'inf'::DOUBLE THEN 3 END AS bin FROM lineitem
""")
def cut_bins(spark, sf):
    li = Tables(spark, sf).lineitem
    return li.select("l_orderkey", "l_linenumber",
                     clean.cut("l_quantity", [-math.inf, 10, 25, 40, math.inf], [0, 1, 2, 3]).alias("bin"))


@register("binarize_median", sql="""
SELECT l_orderkey, l_linenumber,
       (l_extendedprice <= (SELECT median(l_extendedprice) FROM lineitem))::INTEGER AS label FROM lineitem
""")
def binarize_median(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return clean.binarize(li, "l_extendedprice", "median").select("l_orderkey", "l_linenumber", "label")


@register("binarize_threshold", sql="""
SELECT l_orderkey, l_linenumber, (l_quantity <= 25.0)::INTEGER AS label FROM lineitem
""")
def binarize_threshold(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return clean.binarize(li, "l_quantity", 25.0).select("l_orderkey", "l_linenumber", "label")


@register("compound_label", sql=f"""
SELECT l_orderkey, l_linenumber, (yield > 0.75 AND purity >= 0.75 AND price > 50000)::INTEGER AS label
FROM {RUNS_SQL} r
""")
def compound_label(spark, sf):
    r = runs(spark, sf)
    return r.select("l_orderkey", "l_linenumber", clean.compound_label(
        [F.col("yield") > 0.75, F.col("purity") >= 0.75, F.col("price") > 50000]).alias("label"))


@register("contains_text", sql="""
SELECT doc_id FROM documents WHERE contains(text, 'Released under the')
""")
def contains_text(spark, sf):
    return clean.contains(Tables(spark, sf).documents, "text", "Released under the").select("doc_id")


@register("validate_levels", sql="""
SELECT l_orderkey, l_linenumber, 'l_returnflag' AS "column", l_returnflag AS value FROM lineitem
  WHERE l_returnflag NOT IN ('A', 'N', 'R')
UNION ALL
SELECT l_orderkey, l_linenumber, 'l_linestatus', l_linestatus FROM lineitem WHERE l_linestatus NOT IN ('F', 'O')
UNION ALL
SELECT l_orderkey, l_linenumber, 'l_discount', l_discount::VARCHAR FROM lineitem
  WHERE l_discount NOT IN (0.0, 0.02, 0.04, 0.06, 0.08, 0.1)
""")
def validate_levels(spark, sf):
    li = Tables(spark, sf).lineitem
    lv = {
        "l_returnflag": spark.createDataFrame([("A",), ("N",), ("R",)], "v string"),
        "l_linestatus": spark.createDataFrame([("F",), ("O",)], "v string"),
        "l_discount": spark.createDataFrame([(x,) for x in (0.0, 0.02, 0.04, 0.06, 0.08, 0.1)], "v double"),
    }
    return clean.validate_levels(li, ["l_orderkey", "l_linenumber"], lv)


@register("validate_grid", sql="""
WITH s AS (SELECT p_brand AS name, min(p_size)::DOUBLE AS start, max(p_size)::DOUBLE AS "end",
                  (min(p_size) - 1)::DOUBLE AS step FROM part GROUP BY p_brand)
SELECT name, start, "end", step,
       NOT (step IS NULL OR step <= 0 OR abs(("end" - start) / step - round(("end" - start) / step)) > 1e-9) AS ok,
       CASE WHEN step IS NULL OR step <= 0 THEN 'step must be above zero'
            WHEN abs(("end" - start) / step - round(("end" - start) / step)) > 1e-9 THEN 'steps do not reach the end exactly'
       END AS reason
FROM s
""")
def validate_grid(spark, sf):
    pa = Tables(spark, sf).part
    spec = pa.groupBy(F.col("p_brand").alias("name")).agg(
        F.min("p_size").cast("double").alias("start"), F.max("p_size").cast("double").alias("end"),
        (F.min("p_size") - 1).cast("double").alias("step"))
    return clean.validate_grid(spec)


# ---------------------------------------------------------------- F


@register("sort_rank", sql="""
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) AS rank
FROM orders
""")
def sort_rank(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    s = order.sort(o, ["o_orderpriority", F.col("o_totalprice").desc(), "o_orderkey"])
    return s.select("o_orderkey", "rank")


@register("topn", sql="""
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 10
""")
def topn(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return order.topn(li, "l_extendedprice", 10, ["l_orderkey", "l_linenumber"])


_SPACE_SQL = """(SELECT p_partkey, p_retailprice / p_size AS score,
  CASE WHEN p_partkey IN (SELECT l_partkey FROM lineitem) THEN 0 ELSE -1 END AS iteration FROM part)"""


def _space(spark, sf):
    t = Tables(spark, sf)
    seen = t.lineitem.select(F.col("l_partkey").alias("p_partkey")).distinct().withColumn("_seen", F.lit(True))
    pa = t.part.select("p_partkey", (F.col("p_retailprice") / F.col("p_size")).alias("score"))
    return pa.join(seen, "p_partkey", "left").select(
        "p_partkey", "score", F.when(F.col("_seen"), 0).otherwise(-1).cast("int").alias("iteration"))


@register("pick_batch", sql=f"""
WITH s AS {_SPACE_SQL},
b AS (SELECT p_partkey FROM s WHERE iteration = -1 AND score IS NOT NULL ORDER BY score DESC, p_partkey LIMIT 8)
SELECT p_partkey, round(score, 6) AS score,
       CASE WHEN p_partkey IN (SELECT p_partkey FROM b) THEN (SELECT coalesce(max(iteration), -1) + 1 FROM s)
            ELSE iteration END::INTEGER AS iteration FROM s
""")
def pick_batch(spark, sf):
    p = order.pick_batch(_space(spark, sf), "score", 8, "p_partkey")
    return p.select("p_partkey", F.round("score", 6).alias("score"), "iteration")


@register("pick_quantile", sql="""
SELECT doc_id, n_chars FROM documents WHERE n_chars >= (SELECT quantile_cont(n_chars, 0.9) FROM documents)
""")
def pick_quantile(spark, sf):
    d = Tables(spark, sf).documents.select("doc_id", "n_chars")
    return order.pick_quantile(d, "n_chars", 0.1)


# ---------------------------------------------------------------- G


@register("append_rows", sql="""
SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag = 'R'
UNION ALL
SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag <> 'R' OR l_returnflag IS NULL
""")
def append_rows(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_returnflag")
    a = li.where(F.col("l_returnflag") == "R")
    b = li.where((F.col("l_returnflag") != "R") | F.col("l_returnflag").isNull())
    return sets.append(a, b)


@register("distinct_conditions", sql=f"SELECT DISTINCT {', '.join(CONDS)} FROM lineitem")
def distinct_conditions(spark, sf):
    return sets.distinct_conditions(runs(spark, sf), CONDS)


@register("shared_conditions", sql=f"""
SELECT {', '.join(CONDS)}, count(DISTINCT l_suppkey) AS n_entities FROM lineitem
WHERE l_suppkey IS NOT NULL GROUP BY {', '.join(CONDS)} HAVING count(DISTINCT l_suppkey) >= 10
""")
def shared_conditions(spark, sf):
    return sets.shared_conditions(runs(spark, sf), "l_suppkey", CONDS, 10)


@register("difference", sql="""
SELECT DISTINCT p_partkey FROM part WHERE p_partkey NOT IN (
  SELECT l_partkey FROM lineitem WHERE l_partkey IS NOT NULL AND l_quantity > 45 AND l_returnflag = 'R')
""")
def difference(spark, sf):
    t = Tables(spark, sf)
    large = t.lineitem.where("l_quantity > 45 and l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey"))
    return sets.difference(t.part, large, "p_partkey")


@register("undirected_edges", sql="""
SELECT DISTINCT least(l_partkey, l_suppkey) AS u, greatest(l_partkey, l_suppkey) AS v FROM lineitem
""")
def undirected_edges(spark, sf):
    li = Tables(spark, sf).lineitem
    return sets.undirected(li.select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst")))

