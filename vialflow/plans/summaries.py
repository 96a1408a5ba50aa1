"""Section D: aggregations and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vialflow.operators import agg
from vialflow.plans.registry import register
from vialflow.plans.standins import CONDS, ENTITY, RUNS_SQL, runs
from vialflow.sources.tables import Tables


@register("general_condition", headline=True, sql=f"""
WITH r AS {RUNS_SQL},
top AS (SELECT l_suppkey FROM r WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey
        ORDER BY count(*) DESC, l_suppkey LIMIT 10),
per AS (SELECT l_returnflag, l_linestatus, l_discount, l_tax, l_suppkey, avg(yield) AS m
        FROM r WHERE l_suppkey IN (SELECT l_suppkey FROM top)
        GROUP BY l_returnflag, l_linestatus, l_discount, l_tax, l_suppkey)
SELECT l_returnflag, l_linestatus, l_discount, l_tax, count(*) AS coverage,
       round(avg(m), 6) AS mean_yield_all, round(median(m), 6) AS median_yield,
       round(min(m), 6) AS min_yield, round(max(m), 6) AS max_yield
FROM per GROUP BY l_returnflag, l_linestatus, l_discount, l_tax HAVING count(*) >= 8
""")
def general_condition(spark, sf):
    return agg.general_condition(runs(spark, sf), ENTITY, CONDS, "yield", top_n=10, min_cov=8)


@register("replicate_summary", sql=f"""
SELECT l_suppkey, round(avg(yield), 6) AS mean, round(stddev_samp(yield), 6) AS std,
       count(yield) AS n FROM {RUNS_SQL} r GROUP BY l_suppkey
""")
def replicate_summary(spark, sf):
    return agg.replicate_summary(runs(spark, sf), ENTITY, "yield")


@register("summarise", sql="""
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 4) AS sum_qty,
       round(avg(l_extendedprice), 4) AS avg_price, round(max(l_discount), 4) AS max_disc,
       round(min(l_tax), 4) AS min_tax, count(l_orderkey) AS n_lines,
       count(DISTINCT l_suppkey) AS n_suppliers
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def summarise(spark, sf):
    li = Tables(spark, sf).lineitem
    return agg.summarise(li, ["l_returnflag", "l_linestatus"], [
        ("sum_qty", "sum", "l_quantity"), ("avg_price", "mean", "l_extendedprice"),
        ("max_disc", "max", "l_discount"), ("min_tax", "min", "l_tax"),
        ("n_lines", "count", "l_orderkey"), ("n_suppliers", "nunique", "l_suppkey")])


@register("value_counts", sql="""
SELECT event_type, count(*) AS count FROM events GROUP BY event_type
""")
def value_counts(spark, sf):
    return agg.value_counts(Tables(spark, sf).events, "event_type")


@register("top_entities", sql="""
SELECT l_suppkey, count(*) AS count FROM lineitem WHERE l_suppkey IS NOT NULL
GROUP BY l_suppkey ORDER BY count(*) DESC, l_suppkey LIMIT 10
""")
def top_entities(spark, sf):
    return agg.top_entities(Tables(spark, sf).lineitem, "l_suppkey", 10)


_DESCRIBE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _describe_sql():
    parts = []
    for c in _DESCRIBE_COLS:
        parts.append(f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min,
  round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
  round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max FROM lineitem""")
    return "\nUNION ALL\n".join(parts)


@register("describe", sql=_describe_sql())
def describe(spark, sf):
    return agg.describe(Tables(spark, sf).lineitem, _DESCRIBE_COLS)


@register("describe_cat", sql="""
WITH s AS (SELECT o_orderstatus AS v, count(*) AS c FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY 1),
     p AS (SELECT o_orderpriority AS v, count(*) AS c FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1)
SELECT 'o_orderstatus' AS "column", sum(c)::BIGINT AS count, count(*)::BIGINT AS "unique",
       arg_min(v, (-c, v)) AS top, max(c)::BIGINT AS freq FROM s
UNION ALL
SELECT 'o_orderpriority', sum(c)::BIGINT, count(*)::BIGINT, arg_min(v, (-c, v)), max(c)::BIGINT FROM p
""")
def describe_cat(spark, sf):
    return agg.describe_cat(Tables(spark, sf).orders, ["o_orderstatus", "o_orderpriority"])


@register("pivot_mean", sql="""
SELECT l_returnflag,
       round(avg(CASE WHEN l_linestatus = 'F' THEN l_quantity END), 6) AS "F",
       round(avg(CASE WHEN l_linestatus = 'O' THEN l_quantity END), 6) AS "O"
FROM lineitem GROUP BY l_returnflag
""")
def pivot_mean(spark, sf):
    return agg.pivot_mean(Tables(spark, sf).lineitem, "l_returnflag", "l_linestatus",
                          "l_quantity", values=["F", "O"])


def _corr_sql():
    cols = _DESCRIBE_COLS
    parts = []
    for a in cols:
        for b in cols:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM lineitem")
    return "\nUNION ALL\n".join(parts)


@register("corr_matrix", sql=_corr_sql())
def corr_matrix(spark, sf):
    return agg.corr_matrix(Tables(spark, sf).lineitem, _DESCRIBE_COLS)


@register("histogram", sql="""
WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
bins AS (SELECT range AS bin FROM range(20)),
c AS (SELECT CASE WHEN l_extendedprice = hi THEN 19
                  ELSE floor((l_extendedprice - lo) / ((hi - lo) / 20.0))::BIGINT END AS bin,
             count(*) AS n
      FROM lineitem, b WHERE l_extendedprice BETWEEN lo AND hi GROUP BY 1)
SELECT bins.bin, round(lo + bins.bin * ((hi - lo) / 20.0), 6) AS "left",
       round(lo + (bins.bin + 1) * ((hi - lo) / 20.0), 6) AS "right",
       coalesce(c.n, 0)::BIGINT AS count
FROM bins CROSS JOIN b LEFT JOIN c ON c.bin = bins.bin
""")
def histogram(spark, sf):
    return agg.histogram(Tables(spark, sf).lineitem, "l_extendedprice", 20)


@register("box_stats", sql="""
WITH q AS (SELECT l_returnflag, count(*) AS n, avg(l_extendedprice) AS mean,
                  quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
                  quantile_cont(l_extendedprice, 0.75) AS q3
           FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY l_returnflag),
w AS (SELECT l.l_returnflag,
             min(CASE WHEN l_extendedprice >= q1 - 1.5 * (q3 - q1) THEN l_extendedprice END) AS whisker_lo,
             max(CASE WHEN l_extendedprice <= q3 + 1.5 * (q3 - q1) THEN l_extendedprice END) AS whisker_hi,
             sum(CASE WHEN l_extendedprice < q1 - 1.5 * (q3 - q1) OR l_extendedprice > q3 + 1.5 * (q3 - q1)
                      THEN 1 ELSE 0 END)::BIGINT AS n_outliers
      FROM lineitem l JOIN q USING (l_returnflag) GROUP BY l.l_returnflag)
SELECT q.l_returnflag, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(q3 - q1, 6) AS iqr, round(whisker_lo, 6) AS whisker_lo, round(whisker_hi, 6) AS whisker_hi,
       n_outliers, round(mean, 6) AS mean
FROM q JOIN w USING (l_returnflag)
""")
def box_stats(spark, sf):
    return agg.box_stats(Tables(spark, sf).lineitem, "l_returnflag", "l_extendedprice")


@register("line_fit", sql="""
SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept,
       round(regr_r2(l_extendedprice, l_quantity), 6) AS r2,
       regr_count(l_extendedprice, l_quantity)::BIGINT AS n
FROM lineitem GROUP BY l_returnflag
""")
def line_fit(spark, sf):
    return agg.line_fit(Tables(spark, sf).lineitem, "l_quantity", "l_extendedprice", by="l_returnflag")


@register("fit_residuals", sql="""
WITH f AS (SELECT l_returnflag, regr_slope(l_extendedprice, l_quantity) AS m,
                  regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem GROUP BY l_returnflag)
SELECT l_returnflag, round(sqrt(avg((l_extendedprice - (m * l_quantity + b)) ^ 2)), 4) AS rmse,
       round(max(abs(l_extendedprice - (m * l_quantity + b))), 4) AS max_abs_residual
FROM lineitem JOIN f USING (l_returnflag) GROUP BY l_returnflag
""")
def fit_residuals(spark, sf):
    return agg.fit_residuals(Tables(spark, sf).lineitem, "l_quantity", "l_extendedprice", "l_returnflag")


@register("best_by_entity", sql=f"""
WITH per AS (SELECT l_suppkey, l_returnflag, l_linestatus, l_discount, l_tax,
                    round(avg(yield), 6) AS mean, round(avg(yield), 12) AS m, count(*) AS n_runs
             FROM {RUNS_SQL} r WHERE l_suppkey IS NOT NULL AND l_returnflag IS NOT NULL
               AND l_linestatus IS NOT NULL AND l_discount IS NOT NULL AND l_tax IS NOT NULL
             GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY m DESC, l_returnflag,
                                     l_linestatus, l_discount, l_tax) AS rn FROM per)
SELECT l_suppkey, l_returnflag, l_linestatus, l_discount, l_tax, mean, n_runs FROM rk WHERE rn = 1
""")
def best_by_entity(spark, sf):
    return agg.best_by_entity(runs(spark, sf), ENTITY, CONDS, "yield")


# Training-log stand-in: run = user_id, epoch = day index of ts, 'view' rows
# carry the train loss, 'click' rows the validation loss (sparse rows).
def _log_table(spark, sf):
    ev = Tables(spark, sf).events
    return ev.select(
        F.col("user_id").alias("run"),
        F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).cast("bigint").alias("epoch"),
        F.when(F.col("event_type") == "view", F.col("value") / 100.0).alias("train_loss"),
        F.when(F.col("event_type") == "click", F.col("value") / 100.0).alias("val_loss"))


@register("best_epoch", sql="""
WITH l AS (SELECT user_id AS run, (CAST(ts AS DATE) - DATE '2024-01-01')::BIGINT AS epoch,
                  CASE WHEN event_type = 'view' THEN value / 100.0 END AS train_loss,
                  CASE WHEN event_type = 'click' THEN value / 100.0 END AS val_loss FROM events),
per AS (SELECT run, epoch, max(train_loss) AS tr, max(val_loss) AS va FROM l GROUP BY run, epoch)
SELECT run, arg_min(epoch, (va IS NULL, va, epoch)) AS best_epoch, round(min(va), 6) AS best_val_loss,
       max(epoch) AS final_epoch, round(arg_max(tr, CASE WHEN tr IS NOT NULL THEN epoch END), 6) AS last_train_loss,
       count(*) AS n_epochs
FROM per GROUP BY run
""")
def best_epoch(spark, sf):
    return agg.best_epoch(_log_table(spark, sf), "run", "epoch", "train_loss", "val_loss")


@register("latency_summary", sql="""
SELECT event_type, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.95), 6) AS p95,
       count(*) AS n FROM events GROUP BY event_type
""")
def latency_summary(spark, sf):
    return agg.latency_summary(Tables(spark, sf).events, "event_type", "value")

