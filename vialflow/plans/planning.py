"""Section M: experiment planning (plus D15/D16 worklist summaries)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vialflow.functions.stats import rnd, rnd_half_up


def _rh(x):
    """SQL twin of rnd_half_up."""
    return f"round(({x}) + sign({x}) * 1e-9, 6)"
from vialflow.operators import planning as P
from vialflow.operators.pareto import hypervolume_3d as volume_3d
from vialflow.operators.pareto import pareto_nd
from vialflow.plans.columns import _u
from vialflow.plans.registry import register
from vialflow.plans.standins import ARMS_SQL, RUNS_SQL, arm_log, runs
from vialflow.sources.tables import Tables

# Fixed design steps for the grid stand-in (start/end come from the data).
STEPS = {"quantity": 7.0, "discount": 0.02, "tax": 0.04}
SOURCE = {"quantity": "l_quantity", "discount": "l_discount", "tax": "l_tax"}
NAMES = ["quantity", "discount", "tax"]


def _spec(spark, sf, steps=None):
    steps = steps or STEPS
    li = Tables(spark, sf).lineitem
    parts = [li.agg(F.lit(n).alias("name"), F.min(SOURCE[n]).cast("double").alias("start"),
                    F.max(SOURCE[n]).cast("double").alias("end"), F.lit(steps[n]).alias("step"))
             for n in NAMES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _space(spark, sf, steps=None):
    return P.build_space(P.grid_levels(_spec(spark, sf, steps)), NAMES, ["yield", "purity"])


def _levels_sql(n):
    c = SOURCE[n]
    st = STEPS[n]
    return (f"(SELECT round(lo + i * {st}::DOUBLE, 10) AS var_{n} FROM "
            f"(SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM lineitem), "
            f"LATERAL (SELECT unnest(range(0, round((hi - lo) / {st}::DOUBLE)::BIGINT + 1)) AS i))")


_SPACE_SQL = (f"(SELECT *, NULL::DOUBLE AS obj_yield, NULL::DOUBLE AS obj_purity, -1 AS iteration FROM "
              f"{_levels_sql('quantity')} a, {_levels_sql('discount')} b, {_levels_sql('tax')} c)")


@register("build_space", sql=f"SELECT * FROM {_SPACE_SQL}")
def build_space(spark, sf):
    return _space(spark, sf)


_RUNS_GRID_SQL = """(SELECT round(l_quantity::DOUBLE, 10) AS var_quantity, round(l_discount, 10) AS var_discount,
  round(l_tax, 10) AS var_tax, l_quantity / 50.0 AS obj_yield, 1.0 - l_discount * 5.0 AS obj_purity, l_shipdate,
  l_orderkey, l_linenumber FROM lineitem)"""


def _runs_grid(spark, sf):
    li = Tables(spark, sf).lineitem
    return li.select(F.col("l_quantity").alias("var_quantity"), F.col("l_discount").alias("var_discount"),
                     F.col("l_tax").alias("var_tax"), (F.col("l_quantity") / 50.0).alias("obj_yield"),
                     (F.lit(1.0) - F.col("l_discount") * 5.0).alias("obj_purity"),
                     "l_shipdate", "l_orderkey", "l_linenumber")


_VARS = ["var_quantity", "var_discount", "var_tax"]
_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "obj_yield", "obj_purity"]


def _merged(spark, sf, steps=None):
    return P.merge_runs(_space(spark, sf, steps), _runs_grid(spark, sf), _VARS, ["obj_yield", "obj_purity"], _ORDER)


_MERGED_SQL = f"""(WITH s AS {_SPACE_SQL}, r0 AS {_RUNS_GRID_SQL},
r AS (SELECT *, row_number() OVER (ORDER BY {', '.join(_ORDER)}, var_quantity, var_discount, var_tax) AS it
      FROM r0 SEMI JOIN s USING (var_quantity, var_discount, var_tax)),
w AS (SELECT var_quantity, var_discount, var_tax, arg_max({{'y': obj_yield, 'p': obj_purity, 'it': it}}, it) AS win
      FROM r GROUP BY ALL)
SELECT s.var_quantity, s.var_discount, s.var_tax, coalesce(w.win.y, s.obj_yield) AS obj_yield,
       coalesce(w.win.p, s.obj_purity) AS obj_purity, coalesce(w.win.it, s.iteration)::BIGINT AS iteration
FROM s LEFT JOIN w USING (var_quantity, var_discount, var_tax))"""


@register("merge_runs", sql=f"""
SELECT var_quantity, var_discount, var_tax, round(obj_yield, 6) AS obj_yield, round(obj_purity, 6) AS obj_purity,
       iteration FROM {_MERGED_SQL}
""")
def merge_runs(spark, sf):
    m, _ = _merged(spark, sf)
    return m.select(*_VARS, rnd("obj_yield").alias("obj_yield"), rnd("obj_purity").alias("obj_purity"), "iteration")


@register("merge_run_errors", sql=f"""
WITH s AS {_SPACE_SQL}, r AS {_RUNS_GRID_SQL}
SELECT var_quantity, var_discount, var_tax, l_shipdate, l_orderkey, l_linenumber, obj_yield, obj_purity,
       'point not in design space' AS error FROM r ANTI JOIN s USING (var_quantity, var_discount, var_tax)
""")
def merge_run_errors(spark, sf):
    _, e = _merged(spark, sf)
    return e


# ---------------------------------------------------------------- scores
def _ensemble(spark, sf):
    r = runs(spark, sf)
    return r.groupBy("l_partkey").agg(
        F.avg("yield").alias("mu_yield"), (F.stddev_pop("yield") + F.lit(1e-6)).alias("sd_yield"),
        F.avg("purity").alias("mu_purity"), (F.stddev_pop("purity") + F.lit(1e-6)).alias("sd_purity"),
        F.count(F.lit(1)).alias("n_members"))


_ENS_SQL = f"""(SELECT l_partkey, avg(yield) AS mu_yield, stddev_pop(yield) + 1e-6 AS sd_yield,
  avg(purity) AS mu_purity, stddev_pop(purity) + 1e-6 AS sd_purity, count(*) AS n_members
  FROM {RUNS_SQL} r GROUP BY l_partkey)"""


@register("ensemble_mu_sigma", sql=f"""
SELECT l_partkey, round(avg(yield), 6) AS mu, round(stddev_pop(yield) + 1e-6, 6) AS sigma, count(*) AS n_members
FROM {RUNS_SQL} r GROUP BY l_partkey
""")
def ensemble_mu_sigma(spark, sf):
    e = P.ensemble_mu_sigma(runs(spark, sf), "l_partkey", "yield")
    return e.select("l_partkey", rnd("mu").alias("mu"), rnd("sigma").alias("sigma"), "n_members")


def _phi_sql(z):
    t = f"(1.0 / (1.0 + 0.3275911 * abs(({z}) / sqrt(2.0))))"
    poly = f"({t} * (0.254829592 + {t} * (-0.284496736 + {t} * (1.421413741 + {t} * (-1.453152027 + {t} * 1.061405429)))))"
    y = f"(1.0 - {poly} * exp(-(({z}) / sqrt(2.0)) * (({z}) / sqrt(2.0))))"
    return f"(0.5 * (1.0 + CASE WHEN ({z}) < 0 THEN -{y} ELSE {y} END))"


_PDF = "(exp(-0.5 * z * z) / sqrt(2 * pi()))"


@register("acquisition", sql=f"""
WITH e AS {_ENS_SQL},
s AS (SELECT l_partkey, 0.7 * mu_yield + 0.3 * mu_purity AS mu_s,
             sqrt((0.7 * sd_yield) ^ 2 + (0.3 * sd_purity) ^ 2) AS sigma_s FROM e),
b AS (SELECT max(mu_s) AS best FROM s),
z AS (SELECT l_partkey, mu_s, sigma_s, mu_s - best - 0.01 AS imp,
             CASE WHEN sigma_s > 0 THEN (mu_s - best - 0.01) / sigma_s ELSE 0.0 END AS z FROM s, b)
SELECT l_partkey, {_rh('mu_s')} AS mu_s, round(sigma_s, 6) AS sigma_s,
       round(CASE WHEN sigma_s <= 0 THEN 0.0 ELSE greatest(imp * {_phi_sql('z')} + sigma_s * {_PDF}, 0.0) END, 6) AS ei,
       round(CASE WHEN sigma_s > 0 THEN {_phi_sql('z')} ELSE 0.0 END, 6) AS pi,
       round(mu_s + 2.0 * sigma_s, 6) AS ucb, {_rh('mu_s')} AS greedy
FROM z
""")
def acquisition(spark, sf):
    e = _ensemble(spark, sf)
    s = e.select("l_partkey", *P.scalarise({"y": 0.7, "p": 0.3}, {"y": "mu_yield", "p": "mu_purity"},
                                           {"y": "sd_yield", "p": "sd_purity"}))
    best = s.agg(F.max("mu_s")).scalar()
    return s.select("l_partkey", rnd_half_up("mu_s").alias("mu_s"), rnd("sigma_s").alias("sigma_s"),
                    rnd(P.acquire("mu_s", "sigma_s", "ei", best, xi=0.01)).alias("ei"),
                    rnd(P.acquire("mu_s", "sigma_s", "pi", best, xi=0.01)).alias("pi"),
                    rnd(P.acquire("mu_s", "sigma_s", "ucb", kappa=2.0)).alias("ucb"),
                    rnd_half_up(P.acquire("mu_s", "sigma_s", "greedy")).alias("greedy"))


# ---------------------------------------------------------------- Pareto
_FRONT_SQL = f"""(WITH r AS (SELECT l_orderkey, l_linenumber, yield, purity FROM {RUNS_SQL} r0),
px AS (SELECT yield, max(purity) AS v FROM r GROUP BY yield),
st AS (SELECT yield, v, max(v) OVER (ORDER BY yield DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS strict FROM px)
SELECT r.l_orderkey, r.l_linenumber, r.yield, r.purity FROM r JOIN st USING (yield)
WHERE NOT ((st.strict IS NOT NULL AND st.strict >= r.purity) OR st.v > r.purity))"""


def _front(spark, sf):
    r = runs(spark, sf).select("l_orderkey", "l_linenumber", "yield", "purity")
    return P.pareto_2d(r, "yield", "purity").where("on_front").drop("on_front")


@register("pareto_front", sql=f"SELECT * FROM {_FRONT_SQL}")
def pareto_front(spark, sf):
    return _front(spark, sf)


@register("hypervolume_2d", sql=f"""
WITH f AS {_FRONT_SQL},
o AS (SELECT yield AS x, max(purity) OVER (ORDER BY yield DESC, purity DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS env,
             coalesce(lead(yield) OVER (ORDER BY yield DESC, purity DESC), 0.0) AS nx FROM f)
SELECT round(coalesce(sum(greatest(0.0, x - nx) * greatest(0.0, env - 0.0)), 0.0), 6) AS hypervolume FROM o
""")
def hypervolume_2d(spark, sf):
    hv = P.hypervolume_2d(_front(spark, sf), "yield", "purity", (0.0, 0.0))
    return hv.select(rnd("hypervolume").alias("hypervolume"))


# three objectives: yield, purity and a low price
_POINTS3_SQL = f"(SELECT DISTINCT yield AS x, purity AS y, -price AS z FROM {RUNS_SQL} r0)"
#: Points that no other dominates; per (x, y) only the highest z can, so few are compared.
_FRONT3_SQL = f"""(WITH b AS (SELECT x, y, max(z) AS z FROM {_POINTS3_SQL} p GROUP BY x, y)
SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM b q WHERE q.x >= b.x AND q.y >= b.y AND q.z >= b.z
                                  AND (q.x > b.x OR q.y > b.y OR q.z > b.z)))"""


def _objectives3(spark, sf):
    return runs(spark, sf).select("l_orderkey", "l_linenumber", "yield", "purity", (-F.col("price")).alias("cheapness"))


@register("pareto_front_3", sql=f"""
SELECT r.l_orderkey, r.l_linenumber, r.yield, r.purity, -r.price AS cheapness FROM {RUNS_SQL} r
JOIN {_FRONT3_SQL} f ON f.x = r.yield AND f.y = r.purity AND f.z = -r.price
""")
def pareto_front_3(spark, sf):
    """Runs that no other run beats in yield, purity and price together."""
    p = pareto_nd(_objectives3(spark, sf), ["yield", "purity", "cheapness"])
    return p.where("on_front").drop("on_front")


# prices lie below 120,000; the volume is taken above (0, 0, -120,000)
@register("hypervolume_3d", sql=f"""
WITH f AS {_FRONT3_SQL}, u AS (SELECT x, y, z + 120000.0 AS z FROM f WHERE x > 0 AND y > 0 AND z > -120000.0),
xs AS (SELECT x, x - coalesce(lag(x) OVER (ORDER BY x), 0.0) AS w FROM (SELECT DISTINCT x FROM u)),
ys AS (SELECT y, y - coalesce(lag(y) OVER (ORDER BY y), 0.0) AS h FROM (SELECT DISTINCT y FROM u)),
cells AS (SELECT xs.x, ys.y, any_value(w * h) AS a, max(u.z) AS top FROM xs, ys JOIN u ON u.x >= xs.x AND u.y >= ys.y GROUP BY xs.x, ys.y)
SELECT round(coalesce(sum(a * top), 0.0), 3) AS hypervolume FROM cells
""")
def hypervolume_3d(spark, sf):
    hv = volume_3d(_objectives3(spark, sf), "yield", "purity", "cheapness", (0.0, 0.0, -120000.0))
    return hv.select(F.round("hypervolume", 3).alias("hypervolume"))


@register("simplex_weights", sql=f"""
WITH e AS (SELECT event_id, -ln(1.0 - {_u('event_id', '4:0')}) AS e0, -ln(1.0 - {_u('event_id', '4:1')}) AS e1,
                  -ln(1.0 - {_u('event_id', '4:2')}) AS e2 FROM events)
SELECT event_id, round(e0 / (e0 + e1 + e2), 6) AS w0, round(e1 / (e0 + e1 + e2), 6) AS w1,
       round(e2 / (e0 + e1 + e2), 6) AS w2 FROM e
""")
def simplex_weights(spark, sf):
    w = P.simplex_weights(Tables(spark, sf).events, "event_id", 3, 4)
    return w.select("event_id", *[rnd(f"w{j}").alias(f"w{j}") for j in range(3)])


# ---------------------------------------------------------------- bandits
_STATS_SQL = f"""(SELECT user_id, arm, count(reward) AS pulls, sum(reward) AS total, avg(reward) AS mean
  FROM {ARMS_SQL} a GROUP BY user_id, arm)"""


def _stats(spark, sf):
    return P.arm_stats(arm_log(spark, sf), "user_id", "arm", "reward")


@register("arm_stats", sql=f"""
SELECT user_id, arm, pulls, round(total, 6) AS total, {_rh('mean')} AS mean FROM {_STATS_SQL}
""")
def arm_stats(spark, sf):
    s = _stats(spark, sf)
    return s.select("user_id", "arm", "pulls", rnd("total").alias("total"), rnd_half_up("mean").alias("mean"))


_ALL_ARMS_SQL = f"""(SELECT u.user_id, a.arm, coalesce(s.pulls, 0) AS pulls, coalesce(s.total, 0.0) AS total
  FROM (SELECT DISTINCT user_id FROM {_STATS_SQL}) u CROSS JOIN (SELECT DISTINCT arm FROM {_STATS_SQL}) a
  LEFT JOIN {_STATS_SQL} s ON s.user_id = u.user_id AND s.arm = a.arm)"""

_UCB_SQL = f"""(SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ucb DESC, arm) = 1 AS chosen FROM (
  SELECT user_id, arm, pulls, total,
         CASE WHEN pulls = 0 THEN 'inf'::DOUBLE
              ELSE total / pulls + sqrt(2.0 * ln(greatest(sum(pulls) OVER (PARTITION BY user_id), 1)) / pulls) END AS ucb
  FROM {_ALL_ARMS_SQL}))"""


@register("ucb1", sql=f"SELECT user_id, arm, pulls, round(ucb, 6) AS ucb, chosen FROM {_UCB_SQL}")
def ucb1(spark, sf):
    u = P.ucb1(_stats(spark, sf), "user_id", "arm")
    return u.select("user_id", "arm", "pulls", rnd("ucb").alias("ucb"), "chosen")


@register("eps_greedy", sql=f"""
WITH a AS (SELECT *, CASE WHEN pulls > 0 THEN total / pulls ELSE 0.0 END AS m FROM {_ALL_ARMS_SQL}),
o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY arm) - 1 AS k,
             count(*) OVER (PARTITION BY user_id) AS n,
             row_number() OVER (PARTITION BY user_id ORDER BY m DESC, arm) AS g FROM a)
SELECT user_id, arm, pulls, {_u('user_id', '9:e')} < 0.1 AS explored,
       CASE WHEN {_u('user_id', '9:e')} < 0.1 THEN k = floor({_u('user_id', '9:a')} * n) ELSE g = 1 END AS chosen
FROM o
""")
def eps_greedy(spark, sf):
    return P.eps_greedy(_stats(spark, sf), "user_id", "arm", 0.1, 9)


@register("thompson_state", sql=f"""
SELECT user_id, arm, pulls, round(1.0 + total, 6) AS alpha, round(1.0 + pulls - total, 6) AS beta,
       round((1.0 + total) / (2.0 + pulls), 6) AS post_mean,
       round((1.0 + total) * (1.0 + pulls - total) / ((2.0 + pulls) ^ 2 * (3.0 + pulls)), 6) AS post_var
FROM {_STATS_SQL}
""")
def thompson_state(spark, sf):
    t = P.thompson_state(_stats(spark, sf), "user_id", "arm")
    return t.select("user_id", "arm", "pulls", *[rnd(c).alias(c) for c in ("alpha", "beta", "post_mean", "post_var")])


@register("thompson_draw")
def thompson_draw(spark, sf):
    """Seeded Beta draw per (entity, arm); randomised, so rows-only check."""
    t = P.thompson_state(_stats(spark, sf), "user_id", "arm")
    return P.thompson_draw(t, "user_id", "arm", 5).select("user_id", "arm", "draw")


@register("agent_report", sql=f"""
WITH s AS {_STATS_SQL},
b AS (SELECT user_id, arm, pulls, {_rh('mean')} AS mean,
             round(mean, 12) AS m, row_number() OVER (PARTITION BY user_id ORDER BY round(mean, 12) DESC, arm) AS rk FROM s),
best AS (SELECT user_id, arm, pulls, mean, m FROM b WHERE rk = 1)
SELECT user_id, arm, pulls, mean, row_number() OVER (ORDER BY m DESC, user_id) <= 3 AS recommended FROM best
""")
def agent_report(spark, sf):
    from vialflow.operators.window import first_per_group
    s = _stats(spark, sf).withColumns({"_m": F.round("mean", 12), "mean": rnd_half_up("mean")})
    best = first_per_group(s, "user_id", [F.col("_m").desc(), "arm"]).select("user_id", "arm", "pulls", "mean", "_m")
    top = best.orderBy(F.col("_m").desc(), "user_id").limit(3).select("user_id", F.lit(True).alias("_top"))
    return best.join(F.broadcast(top), "user_id", "left").select(
        "user_id", "arm", "pulls", "mean", F.coalesce("_top", F.lit(False)).alias("recommended"))


@register("replay_value", sql=f"""
WITH p AS (SELECT user_id, arm FROM {_UCB_SQL} WHERE chosen)
SELECT a.user_id, count(*) AS matched, {_rh('avg(a.reward)')} AS value
FROM {ARMS_SQL} a JOIN p ON a.user_id = p.user_id AND a.arm = p.arm GROUP BY a.user_id
""")
def replay_value(spark, sf):
    pol = P.ucb1(_stats(spark, sf), "user_id", "arm").where("chosen").select("user_id", "arm")
    j = arm_log(spark, sf).join(pol, ["user_id", "arm"])
    return j.groupBy("user_id").agg(F.count(F.lit(1)).alias("matched"), rnd_half_up(F.avg("reward")).alias("value"))


# ---------------------------------------------------------------- worklist
#: What ``worklist_coverage`` sets against all combinations: two plates.
_CAPACITY = 192


def _worklist(spark, sf):
    """Orders are the reactions, their lines the transfers: part type and brand
    name the stock, the quantity is the volume."""
    t = Tables(spark, sf)
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand")
    return P.reaction_worklist(lines.join(parts, "l_partkey"), "l_orderkey", "l_linenumber", "p_type", "p_brand", "l_quantity")


_WL_SQL = """(WITH t AS (SELECT l_orderkey AS reaction, l_linenumber AS step, p_type AS category, p_brand AS stock, l_quantity AS volume
           FROM lineitem JOIN part ON l_partkey = p_partkey),
i AS (SELECT reaction, row_number() OVER (ORDER BY reaction) - 1 AS idx FROM (SELECT DISTINCT reaction FROM t))
SELECT t.reaction, (i.idx // 96)::BIGINT AS plate, chr((65 + (i.idx % 96) // 12)::INTEGER) || ((i.idx % 96) % 12 + 1)::VARCHAR AS well,
       t.step, t.category, t.stock, t.volume FROM t JOIN i USING (reaction))"""


@register("worklist", sql=f"SELECT * FROM {_WL_SQL}")
def worklist(spark, sf):
    return _worklist(spark, sf)


@register("worklist_coverage", sql=f"""
WITH n AS (SELECT count(DISTINCT p_brand) AS n FROM part GROUP BY p_type),
t AS (SELECT round(product(n))::BIGINT AS possible FROM n)
SELECT possible, least(possible, {_CAPACITY}) AS scheduled, greatest(possible - {_CAPACITY}, 0) AS left_out FROM t
""")
def worklist_coverage(spark, sf):
    stocks = Tables(spark, sf).part.select("p_type", "p_brand").distinct()
    cats = [r[0] for r in stocks.select("p_type").distinct().collect()]  # a few category names
    return P.worklist_coverage(stocks, "p_type", "p_brand", cats, _CAPACITY)


@register("stock_consumption", sql=f"""
SELECT category, stock, sum(volume) AS total_volume, count(*) AS n_transfers FROM {_WL_SQL} GROUP BY category, stock
""")
def stock_consumption(spark, sf):
    return P.stock_consumption(_worklist(spark, sf))


@register("schedule_estimate", sql=f"""
SELECT count(*) AS n_actions, (count(*) * 12.5)::DOUBLE AS seconds, count(*) * 12.5 > 3600.0 AS split FROM {_WL_SQL}
""")
def schedule_estimate(spark, sf):
    return P.schedule_estimate(_worklist(spark, sf), 12.5, 3600.0)


# ---------------------------------------------------------------- simulation
@register("inject_quirks", sql=f"""
WITH r AS (SELECT o_orderkey, o_totalprice / 600000.0 AS y,
                  row_number() OVER (ORDER BY {_u('o_orderkey', 21)}, o_orderkey) AS rk, count(*) OVER () AS n FROM orders),
q AS (SELECT *, CASE WHEN rk <= floor(n * 0.05) THEN 'fail' WHEN rk <= floor(n * 0.05) + floor(n * 0.1) THEN 'low'
                     WHEN rk <= floor(n * 0.05) + floor(n * 0.1) + floor(n * 0.1) THEN 'boost' END AS quirk FROM r)
SELECT o_orderkey, {_rh("CASE quirk WHEN 'fail' THEN 0.0 WHEN 'low' THEN y * 0.5 WHEN 'boost' THEN least(1.0, y * 1.2) ELSE y END")} AS y, quirk FROM q
""")
def inject_quirks(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", (F.col("o_totalprice") / 600000.0).alias("y"))
    q = P.inject_quirks(o, "o_orderkey", "y", {"fail": 0.05, "low": 0.1, "boost": 0.1}, 21)
    return q.select("o_orderkey", rnd_half_up("y").alias("y"), "quirk")


@register("reveal_positives", sql=f"""
SELECT doc_id, quality, (quality = 1 AND {_u('doc_id', 17)} < 0.6)::INTEGER AS s FROM labels
""")
def reveal_positives(spark, sf):
    return P.reveal_positives(Tables(spark, sf).labels.select("doc_id", "quality"), "doc_id", "quality", 0.6, 17)


@register("compare_strategies", sql="""
WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS step FROM events)
SELECT event_type, b.budget, max(CASE WHEN step <= b.budget THEN value END) AS best
FROM r, (VALUES (10), (100), (1000)) b(budget) GROUP BY event_type, b.budget
""")
def compare_strategies(spark, sf):
    ev = Tables(spark, sf).events.select("event_id", "ts", "event_type", "value")
    return P.compare_strategies(ev, "event_type", ["ts", "event_id"], "value", [10, 100, 1000])


@register("hv_trace", sql="""
WITH p AS (SELECT year(l_shipdate)::INTEGER AS fr, l_quantity / 50.0 AS x, 1.0 - l_discount * 5.0 AS y FROM lineitem),
b AS (SELECT fr, x, max(y) AS y FROM p GROUP BY fr, x),
r AS (SELECT DISTINCT fr AS round FROM p),
per AS (SELECT round, x, max(y) AS y FROM b JOIN r ON r.round >= b.fr GROUP BY round, x),
s AS (SELECT round, greatest(0.0, x - coalesce(lead(x) OVER w, 0.0)) *
                    greatest(0.0, max(y) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS a
      FROM per WINDOW w AS (PARTITION BY round ORDER BY x DESC))
SELECT round, round(sum(a), 6) AS hypervolume FROM s GROUP BY round
""")
def hv_trace(spark, sf):
    li = Tables(spark, sf).lineitem.select(F.year("l_shipdate").alias("round"), (F.col("l_quantity") / 50.0).alias("x"),
                                           (F.lit(1.0) - F.col("l_discount") * 5.0).alias("y"))
    h = P.hv_trace(li, "x", "y", "round")
    return h.select("round", rnd("hypervolume").alias("hypervolume"))


def _transitions(spark, sf):
    from vialflow.operators.window import running
    ev = Tables(spark, sf).events.select("event_id", "ts", "user_id", "event_type", "value")
    r = running(ev.withColumn("_one", F.lit(1)), ["ts", "event_id"], {"_i": ("count", "_one")}, ["user_id"],
                block=F.to_date("ts"))
    nxt = r.select("user_id", (F.col("_i") - 1).alias("_i"), F.col("event_type").alias("s2"))
    return r.join(nxt, ["user_id", "_i"], "left").select(
        F.col("event_type").alias("s"), F.when(F.col("value") > 100, "high").otherwise("low").alias("a"),
        (F.col("value") / 500.0).alias("r"), "s2")


@register("q_iterate", sql="""
WITH t AS (SELECT event_type AS s, CASE WHEN value > 100 THEN 'high' ELSE 'low' END AS a, value / 500.0 AS r,
                  lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s2 FROM events),
q0 AS (SELECT DISTINCT s, a, 0.0 AS q FROM t),
v0 AS (SELECT s AS s2, max(q) AS v FROM q0 GROUP BY s),
d0 AS (SELECT t.s, t.a, avg(t.r + 0.9 * coalesce(v0.v, 0.0) - q0.q) AS d FROM t LEFT JOIN v0 USING (s2)
       JOIN q0 ON q0.s = t.s AND q0.a = t.a GROUP BY t.s, t.a),
q1 AS (SELECT q0.s, q0.a, q0.q + 0.5 * coalesce(d0.d, 0.0) AS q FROM q0 LEFT JOIN d0 USING (s, a)),
v1 AS (SELECT s AS s2, max(q) AS v FROM q1 GROUP BY s),
d1 AS (SELECT t.s, t.a, avg(t.r + 0.9 * coalesce(v1.v, 0.0) - q1.q) AS d FROM t LEFT JOIN v1 USING (s2)
       JOIN q1 ON q1.s = t.s AND q1.a = t.a GROUP BY t.s, t.a),
q2 AS (SELECT q1.s, q1.a, q1.q + 0.5 * coalesce(d1.d, 0.0) AS q FROM q1 LEFT JOIN d1 USING (s, a))
SELECT s, a, round(q, 6) AS q FROM q2
""")
def q_iterate(spark, sf):
    q = P.q_iterate(_transitions(spark, sf), 0.9, 0.5, 2)
    return q.select("s", "a", rnd("q").alias("q"))


# A finer grid for the GP jobs: half of its quantity levels fall between
# observed values, so the loop has untested candidates.
GP_STEPS = {"quantity": 3.5, "discount": 0.02, "tax": 0.04}


def _space_with_id(spark, sf):
    m, _ = _merged(spark, sf, GP_STEPS)
    pid = F.concat_ws("|", *[F.col(v).cast("string") for v in _VARS])
    return m.withColumn("point_id", pid)


@register("gp_score")
def gp_score(spark, sf):
    """GP mean/sigma of the yield objective for every untested grid point,
    fitted on the completed points (features min-max scaled)."""
    from vialflow.operators.features import apply_minmax, fit_minmax
    sp = _space_with_id(spark, sf)
    mm = fit_minmax(sp, _VARS)
    sc = apply_minmax(sp, mm, _VARS)
    return P.gp_score(sc.where((F.col("iteration") >= 0) & F.col("obj_yield").isNotNull()),
                      sc.where(F.col("iteration") == -1), _VARS, "obj_yield", "point_id")


@register("suggest_batch")
def suggest_batch(spark, sf):
    """Next batch of 5 grid points by GP expected improvement over the
    weighted objectives (random hash picks when nothing is completed)."""
    sp = _space_with_id(spark, sf)
    return P.suggest(sp, "point_id", _VARS, {"obj_yield": 0.7, "obj_purity": 0.3}, 5, 42)
