"""Section C: joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from vialflow.operators import joins
from vialflow.operators.agg import top_entities
from vialflow.plans.registry import register
from vialflow.plans.standins import RUNS_SQL, runs
from vialflow.sources.tables import Tables


@register("enrich", sql="""
SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey
""")
def enrich(spark, sf):
    t = Tables(spark, sf)
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return joins.enrich(o, c, "o_custkey", ["c_name", "c_mktsegment"])


@register("overlay", sql="""
WITH u AS (SELECT l_partkey AS p_partkey,
                  round(avg(CASE WHEN l_quantity <> 0 THEN l_extendedprice / l_quantity END), 2) AS p_retailprice
           FROM lineitem GROUP BY l_partkey)
SELECT p.p_partkey, coalesce(u.p_retailprice, p.p_retailprice) AS p_retailprice, p.p_size
FROM part p LEFT JOIN u ON p.p_partkey = u.p_partkey
""")
def overlay(spark, sf):
    t = Tables(spark, sf)
    base = t.part.select("p_partkey", "p_retailprice", "p_size")
    upd = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.round(F.avg(F.try_divide("l_extendedprice", "l_quantity")), 2).alias("p_retailprice"))
    return joins.overlay(base, upd, "p_partkey", ["p_retailprice"])


@register("factorial", sql="""
SELECT n_nationkey, r_regionkey, l_linestatus FROM nation, region, (SELECT DISTINCT l_linestatus FROM lineitem)
""")
def factorial(spark, sf):
    t = Tables(spark, sf)
    return joins.factorial(t.nation.select("n_nationkey"), t.region.select("r_regionkey"),
                           t.lineitem.select("l_linestatus").distinct())


@register("align", sql="""
SELECT doc_id, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)
""")
def align(spark, sf):
    t = Tables(spark, sf)
    return joins.align(t.documents.select("doc_id", "n_chars"), t.labels, "doc_id")


@register("untested", sql="""
SELECT p_partkey FROM part p WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = p.p_partkey)
""")
def untested(spark, sf):
    t = Tables(spark, sf)
    return joins.untested(t.part.select("p_partkey"),
                          t.lineitem.select(F.col("l_partkey").alias("p_partkey")), "p_partkey")


@register("restrict", sql="""
SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey IN (
  SELECT l_suppkey FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey
  ORDER BY count(*) DESC, l_suppkey LIMIT 10)
""")
def restrict(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    return joins.restrict(li, top_entities(li, "l_suppkey", 10), "l_suppkey")


@register("resolve_fallback", sql="""
WITH p AS (SELECT s_nationkey AS k, min(s_name) AS v FROM supplier GROUP BY s_nationkey),
f AS (SELECT c_nationkey AS k, min(c_name) AS v FROM customer GROUP BY c_nationkey)
SELECT n_nationkey, n_name, coalesce(p.v, f.v) AS value,
       CASE WHEN p.v IS NOT NULL THEN 'primary' WHEN f.v IS NOT NULL THEN 'fallback' END AS source
FROM nation LEFT JOIN p ON p.k = n_nationkey LEFT JOIN f ON f.k = n_nationkey
""")
def resolve_fallback(spark, sf):
    t = Tables(spark, sf)
    prim = t.supplier.groupBy("s_nationkey").agg(F.min("s_name"))
    fb = t.customer.groupBy("c_nationkey").agg(F.min("c_name"))
    return joins.resolve(t.nation.select("n_nationkey", "n_name"), "n_nationkey", prim, fb)


@register("source_agreement", sql="""
WITH a AS (SELECT s_nationkey AS nationkey, count(*) AS n FROM supplier GROUP BY 1),
b AS (SELECT c_nationkey AS nationkey, (count(*) // 15)::BIGINT AS n FROM customer GROUP BY 1)
SELECT coalesce(a.nationkey, b.nationkey) AS nationkey, a.n AS value_a, b.n AS value_b,
       a.n IS NOT DISTINCT FROM b.n AS agree,
       CASE WHEN a.n IS NULL THEN 'b_only' WHEN b.n IS NULL THEN 'a_only' ELSE 'both' END AS presence
FROM a FULL OUTER JOIN b ON a.nationkey = b.nationkey
""")
def source_agreement(spark, sf):
    t = Tables(spark, sf)
    a = t.supplier.groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("n"))
    b = t.customer.groupBy(F.col("c_nationkey").alias("nationkey")).agg(
        F.floor(F.count(F.lit(1)) / 15).cast("bigint").alias("n"))
    return joins.source_agreement(a, b, "nationkey", "n")


@register("lookup_outcomes", sql=f"""
WITH r AS {RUNS_SQL},
p AS (SELECT * FROM (SELECT DISTINCT l_returnflag FROM r), (SELECT DISTINCT l_linestatus FROM r),
      (SELECT DISTINCT l_discount FROM r)),
o AS (SELECT l_returnflag, l_linestatus, l_discount, max(yield) AS outcome FROM r GROUP BY ALL)
SELECT p.l_returnflag, p.l_linestatus, p.l_discount, round(o.outcome, 6) AS outcome
FROM p LEFT JOIN o ON p.l_returnflag = o.l_returnflag AND p.l_linestatus = o.l_linestatus
                   AND p.l_discount = o.l_discount
""")
def lookup_outcomes(spark, sf):
    r = runs(spark, sf)
    props = joins.factorial(r.select("l_returnflag").distinct(), r.select("l_linestatus").distinct(),
                            r.select("l_discount").distinct())
    out = joins.lookup_outcomes(props, r, ["l_returnflag", "l_linestatus", "l_discount"], "yield")
    return out.select("l_returnflag", "l_linestatus", "l_discount", F.round("outcome", 6).alias("outcome"))


@register("snap_levels", sql="""
WITH lv AS (SELECT DISTINCT l_tax AS lv FROM lineitem)
SELECT l_orderkey, l_linenumber,
       (SELECT lv FROM lv ORDER BY abs(l_discount - lv), lv LIMIT 1) AS snapped FROM lineitem
""")
def snap_levels(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_discount")
    levels = Tables(spark, sf).lineitem.select("l_tax")
    return joins.snap(li, "l_discount", levels).select("l_orderkey", "l_linenumber", "snapped")


@register("nearest_row", sql="""
WITH p AS (SELECT s_suppkey, s_acctbal / 200.0 AS x, s_nationkey::DOUBLE AS y FROM supplier),
q AS (SELECT c_custkey, c_acctbal / 200.0 AS x, c_nationkey::DOUBLE AS y FROM customer),
d AS (SELECT s_suppkey, c_custkey, (q.x - p.x) ^ 2 + (q.y - p.y) ^ 2 AS d2 FROM p, q)
SELECT s_suppkey, arg_min(c_custkey, (d2, c_custkey)) AS c_custkey, round(sqrt(min(d2)), 6) AS distance
FROM d GROUP BY s_suppkey
""")
def nearest_row(spark, sf):
    t = Tables(spark, sf)
    props = t.supplier.select("s_suppkey", (F.col("s_acctbal") / 200.0).alias("x"),
                              F.col("s_nationkey").cast("double").alias("y"))
    pool = t.customer.select("c_custkey", (F.col("c_acctbal") / 200.0).alias("x"),
                             F.col("c_nationkey").cast("double").alias("y"))
    out = joins.nearest_row(props, pool, ["x", "y"], "s_suppkey", "c_custkey")
    return out.select("s_suppkey", "c_custkey", F.round("distance", 6).alias("distance"))


_CODE = r"^Customer#[0-9]+$"


@register("resolve_mixed", sql="""
WITH ids AS (SELECT s_suppkey::VARCHAR AS ident FROM supplier UNION ALL SELECT n_name FROM nation
             UNION ALL SELECT c_name FROM customer UNION ALL SELECT DISTINCT o_orderpriority FROM orders),
r AS (SELECT ident, CASE WHEN regexp_full_match(ident, '[0-9]+') THEN 'id'
                         WHEN regexp_matches(ident, '^Customer#[0-9]+$') THEN 'code' ELSE 'name' END AS route FROM ids)
SELECT ident, route, coalesce(s.s_suppkey, c.c_custkey, n.n_nationkey::BIGINT) AS resolved_key,
       coalesce(s.s_suppkey, c.c_custkey, n.n_nationkey::BIGINT) IS NOT NULL AS resolved
FROM r LEFT JOIN supplier s ON route = 'id' AND ident = s.s_suppkey::VARCHAR
       LEFT JOIN customer c ON route = 'code' AND ident = c.c_name
       LEFT JOIN nation n ON route = 'name' AND lower(ident) = lower(n.n_name)
""")
def resolve_mixed(spark, sf):
    t = Tables(spark, sf)
    ids = (t.supplier.select(F.col("s_suppkey").cast("string").alias("ident"))
           .unionByName(t.nation.select(F.col("n_name").alias("ident")))
           .unionByName(t.customer.select(F.col("c_name").alias("ident")))
           .unionByName(t.orders.select(F.col("o_orderpriority").alias("ident")).distinct()))
    return joins.resolve_mixed(
        ids, "ident", _CODE,
        t.supplier.select("s_suppkey", "s_suppkey"),
        t.customer.select("c_name", "c_custkey"),
        t.nation.select("n_name", F.col("n_nationkey").cast("bigint")))
