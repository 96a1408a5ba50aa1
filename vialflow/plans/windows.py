"""Section E: window jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from vialflow.functions.stats import rnd
from vialflow.operators import window as W
from vialflow.plans.registry import register
from vialflow.plans.standins import ARMS_SQL, RUNS_SQL, arm_log, runs
from vialflow.sources.tables import Tables


@register("first_per_group", sql=f"""
SELECT l_suppkey, l_orderkey, l_linenumber, price, rank FROM (
  SELECT l_suppkey, l_orderkey, l_linenumber, price,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY price DESC, l_orderkey, l_linenumber) AS rank
  FROM {RUNS_SQL} r) WHERE rank = 1
""")
def first_per_group(spark, sf):
    r = runs(spark, sf).select("l_suppkey", "l_orderkey", "l_linenumber", "price")
    return W.first_per_group(r, "l_suppkey", [F.col("price").desc(), "l_orderkey", "l_linenumber"])


@register("topk_per_group", sql=f"""
SELECT l_suppkey, l_orderkey, l_linenumber, yield, rank FROM (
  SELECT l_suppkey, l_orderkey, l_linenumber, yield,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY yield DESC, l_orderkey, l_linenumber) AS rank
  FROM {RUNS_SQL} r) WHERE rank <= 3
""")
def topk_per_group(spark, sf):
    r = runs(spark, sf).select("l_suppkey", "l_orderkey", "l_linenumber", "yield")
    return W.topk_per_group(r, "l_suppkey", [F.col("yield").desc(), "l_orderkey", "l_linenumber"], 3)


@register("best_so_far", sql=f"""
SELECT event_id, user_id, round(max(reward) OVER (PARTITION BY user_id ORDER BY ts, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS best_reward FROM {ARMS_SQL} a
""")
def best_so_far(spark, sf):
    a = arm_log(spark, sf).select("event_id", "user_id", "ts", "reward")
    r = W.best_so_far(a, ["ts", "event_id"], ["reward"], by=["user_id"], block=F.to_date("ts"))
    return r.select("event_id", "user_id", rnd("best_reward").alias("best_reward"))


@register("running_mean", sql=f"""
SELECT event_id, user_id, round(m + sign(m) * 1e-9, 6) AS running_mean FROM (
  SELECT event_id, user_id, avg(reward) OVER (PARTITION BY user_id ORDER BY ts, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS m FROM {ARMS_SQL} a)
""")
def running_mean(spark, sf):
    a = arm_log(spark, sf).select("event_id", "user_id", "ts", "reward")
    r = W.running_mean(a, ["ts", "event_id"], "reward", by=["user_id"], block=F.to_date("ts"))
    return r.select("event_id", "user_id", "running_mean")


@register("hit_rate_at_k", sql="""
WITH d AS (SELECT d.doc_id, d.n_chars AS score, l.toxic FROM documents d JOIN labels l USING (doc_id)),
r AS (SELECT *, row_number() OVER (ORDER BY score DESC NULLS LAST, doc_id) AS rk FROM d),
k AS (SELECT unnest([5, 10, 20, 50]) AS k)
SELECT k::BIGINT AS k, sum(toxic)::BIGINT AS hits, count(*)::BIGINT AS n, round(avg(toxic::DOUBLE), 6) AS hit_rate
FROM k JOIN r ON r.rk <= k.k GROUP BY k.k
""")
def hit_rate_at_k(spark, sf):
    t = Tables(spark, sf)
    d = t.documents.select("doc_id", F.col("n_chars").alias("score")).join(t.labels.select("doc_id", "toxic"), "doc_id")
    return W.hit_rate_at_k(d, "score", "toxic", "doc_id", [5, 10, 20, 50])


@register("cumulative_share", sql="""
SELECT s_suppkey, round(sum(s_acctbal) OVER (ORDER BY s_acctbal DESC, s_suppkey
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / (SELECT sum(s_acctbal) FROM supplier), 6) AS cum_share
FROM supplier
""")
def cumulative_share(spark, sf):
    su = Tables(spark, sf).supplier.select("s_suppkey", "s_acctbal")
    r = W.cumulative_share(su, [F.col("s_acctbal").desc(), "s_suppkey"], "s_acctbal",
                           block=W.RANGE)
    return r.select("s_suppkey", "cum_share")


@register("envelope", sql=f"""
SELECT l_orderkey, l_linenumber, round(max(yield) OVER (ORDER BY price DESC, yield DESC
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS envelope FROM {RUNS_SQL} r
""")
def envelope(spark, sf):
    r = runs(spark, sf).select("l_orderkey", "l_linenumber", "price", "yield")
    e = W.envelope(r, "price", "yield", block=W.RANGE)
    return e.select("l_orderkey", "l_linenumber", rnd("envelope").alias("envelope"))


_WELLS_SQL = """(SELECT p_partkey, idx, (idx // 96 + 1)::BIGINT AS plate,
       chr((65 + (idx % 96) // 12)::INTEGER) AS plate_row, ((idx % 96) % 12 + 1)::INTEGER AS plate_col,
       chr((65 + (idx % 96) // 12)::INTEGER) || ((idx % 96) % 12 + 1)::VARCHAR AS well
  FROM (SELECT p_partkey, (row_number() OVER (ORDER BY p_partkey) - 1)::BIGINT AS idx FROM part))"""


@register("assign_wells", sql=f"SELECT * FROM {_WELLS_SQL}")
def assign_wells(spark, sf):
    pa = Tables(spark, sf).part.select("p_partkey")
    return W.assign_wells(pa, ["p_partkey"], block=W.RANGE)


@register("plate_occupancy", sql=f"""
WITH w AS {_WELLS_SQL},
g AS (SELECT plate, chr((65 + r)::INTEGER) AS plate_row FROM (SELECT DISTINCT plate FROM w), range(8) t(r))
SELECT g.plate, g.plate_row, {", ".join(f'count(CASE WHEN w.plate_col = {c} THEN 1 END)::BIGINT AS "{c}"' for c in range(1, 13))}
FROM g LEFT JOIN w ON w.plate = g.plate AND w.plate_row = g.plate_row GROUP BY g.plate, g.plate_row
""")
def plate_occupancy(spark, sf):
    pa = Tables(spark, sf).part.select("p_partkey")
    return W.plate_occupancy(W.assign_wells(pa, ["p_partkey"], block=W.RANGE))


@register("cumulative_regret", sql=f"""
WITH a AS {ARMS_SQL},
b AS (SELECT max(m) AS best FROM (SELECT avg(reward) AS m FROM a GROUP BY arm)),
r AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS t,
             sum(reward) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
      FROM a)
SELECT event_id, t::BIGINT AS t, round(cum, 6) AS cum_reward, round(best * t - cum, 6) AS regret FROM r, b
""")
def cumulative_regret(spark, sf):
    a = arm_log(spark, sf).select("event_id", "ts", "arm", "reward")
    r = W.cumulative_regret(a, "arm", "reward", ["ts", "event_id"], block=W.RANGE)
    return r.select("event_id", "t", "cum_reward", "regret")


@register("representatives", sql="""
SELECT vec_id, label, member FROM (
  SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS member FROM embeddings)
WHERE member <= 2
""")
def representatives(spark, sf):
    em = Tables(spark, sf).embeddings.select("vec_id", "label")
    return W.representatives(em, "label", "vec_id", 2)
