"""Experiment planning: design grids, run merging, scalarisation and
acquisition scores, Pareto fronts and hypervolume, bandit statistics, plate
worklists and simulated quirks.

Scale notes
* Grids are built from level lists (explode of ``sequence``) - the product is
  the design the user asked for.
* Run merging picks "last write wins" with a partial ``max_by`` aggregate, so
  a grid point hit by a third of all runs is reduced map-side.
* The 2-D Pareto mask is exact without pairs: per distinct x the best y
  (partial aggregate), a running max over x descending (block-wise prefix),
  joined back by x.
* Worklists decode a reaction index into one stock per category (mixed
  radix), so the combination product is never materialised.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vialflow.functions.hashing import md5_unit
from vialflow.operators import kernelfit
from vialflow.functions.stats import norm_cdf, norm_pdf, rnd
from vialflow.operators.window import RANGE, row_index, running
from vialflow.session import small

LEVEL_DIGITS = 10


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ------------------------------------------------------------------ grids
def grid_levels(spec: DataFrame, name: str = "name", start: str = "start", end: str = "end",
                step: str = "step") -> DataFrame:
    """(name, level) for every variable: start, start+step, ... up to end
    inclusive (level count = round((end - start) / step) + 1; levels rounded
    to 10 decimals so float steps land on clean values)."""
    n = F.round((F.col(end) - F.col(start)) / F.col(step)).cast("int")
    return spec.select(F.col(name).alias("name"), F.col(start).alias("_s"), F.col(step).alias("_d"),
                       F.explode(F.sequence(F.lit(0), n)).alias("_i")).select(
        "name", F.round(F.col("_s") + F.col("_i") * F.col("_d"), LEVEL_DIGITS).alias("level"))


def build_space(levels: DataFrame, names: Sequence[str], objectives: Sequence[str]) -> DataFrame:
    """Full grid over the variables' levels: ``var_<name>`` columns, NULL
    ``obj_<o>`` columns and ``iteration = -1``. ``names`` fixes the column
    order (the spec's variable list, a handful of names)."""
    out = None
    for nm in names:
        lv = levels.where(F.col("name") == nm).select(F.col("level").alias(f"var_{nm}"))
        out = lv if out is None else out.crossJoin(F.broadcast(lv))  # level lists: bounded
    return out.select("*", *[F.lit(None).cast("double").alias(f"obj_{o}") for o in objectives],
                      F.lit(-1).alias("iteration"))


def merge_runs(space: DataFrame, runs: DataFrame, var_cols: Sequence[str], obj_cols: Sequence[str],
               order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Write completed runs into the grid.

    * ``iteration`` is the place of the run among all runs on grid points, in
      ``order`` and from 1 (a running count over ranges of the order);
    * several runs on one grid point: the last by ``order`` wins (partial
      ``max_by``) and gives the iteration;
    * runs whose point is not in the grid are returned as error rows.
    Returns (merged space, errors).
    """
    var_cols, obj_cols = list(var_cols), list(obj_cols)
    r = runs.select(*[F.round(F.col(v).cast("double"), LEVEL_DIGITS).alias(v) for v in var_cols],
                    *obj_cols, *[o for o in order if o not in obj_cols])
    known = space.select(*var_cols)
    errors = r.join(known, var_cols, "left_anti").select(*var_cols, *order,
                                                         F.lit("point not in design space").alias("error"))
    placed = row_index(r.join(known, var_cols, "left_semi"), [*order, *var_cols], out="_it")
    last = placed.groupBy(*var_cols).agg(
        F.max_by(F.struct(*[F.col(o).alias(o) for o in obj_cols], (F.col("_it") + 1).alias("_it")), F.col("_it")).alias("_w"))
    j = space.join(last, var_cols, "left")
    cols = []
    for c in space.columns:
        if c in obj_cols:
            cols.append(F.coalesce(F.col(f"_w.{c}"), F.col(c)).alias(c))
        elif c == "iteration":
            cols.append(F.coalesce(F.col("_w._it"), F.col(c)).cast("bigint").alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols), errors


# ------------------------------------------------------------------ scores
def scalarise(weights: Mapping[str, float], mu: Mapping[str, str], sigma: Mapping[str, str]) -> list[Column]:
    """``mu_s = sum w * mu``, ``sigma_s = sqrt(sum (w * sigma)^2)`` (independent)."""
    m = None
    v = None
    for k, w in weights.items():
        t = F.lit(float(w)) * F.col(mu[k])
        m = t if m is None else m + t
        s = (F.lit(float(w)) * F.col(sigma[k])) ** 2
        v = s if v is None else v + s
    return [m.alias("mu_s"), F.sqrt(v).alias("sigma_s")]


def acquire(mu: Column | str, sigma: Column | str, kind: str, best: Column | float | None = None,
            xi: float = 0.0, kappa: float = 2.0) -> Column:
    """EI (0 when sigma <= 0, never negative), PI, UCB or greedy score."""
    mu, sigma = _c(mu), _c(sigma)
    b = best if isinstance(best, Column) else F.lit(best)
    if kind == "greedy":
        return mu
    if kind == "ucb":
        return mu + F.lit(kappa) * sigma
    # standard scores; certain candidates (sigma <= 0) have nothing to gain
    score = (mu - F.lit(xi) - b) / F.when(sigma > 0, sigma)
    if kind == "pi":
        return F.coalesce(norm_cdf(score), F.lit(0.0))
    if kind == "ei":
        return F.coalesce(F.greatest(sigma * (score * norm_cdf(score) + norm_pdf(score)), F.lit(0.0)), F.lit(0.0))
    raise ValueError(kind)


def ensemble_mu_sigma(preds: DataFrame, key: str, pred: str, eps: float = 1e-6) -> DataFrame:
    """Mean and population std (+eps) of per-member predictions per candidate."""
    return preds.groupBy(key).agg(F.avg(pred).alias("mu"),
                                  (F.stddev_pop(pred) + F.lit(eps)).alias("sigma"),
                                  F.count(F.lit(1)).alias("n_members"))


# ------------------------------------------------------------------ Pareto
def pareto_2d(df: DataFrame, x: str, y: str, out: str = "on_front") -> DataFrame:
    """Non-dominated mask for two maximised objectives (ties do not dominate:
    equal points all stay). A point p is dominated iff some q has
    q.x > p.x and q.y >= p.y, or q.x == p.x and q.y > p.y."""
    per_x = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(x).agg(F.max(y).alias("_v"))
    # best y among strictly larger x: exclusive running max over distinct x
    strict = running(per_x, [F.col(x).desc()], {"_strict": ("max", "_v")}, (),
                     block=RANGE, exclusive=True)
    j = df.join(strict, x, "left")
    dominated = ((F.col("_strict").isNotNull() & (F.col("_strict") >= F.col(y))) | (F.col("_v") > F.col(y)))
    keep = F.when(F.col(x).isNull() | F.col(y).isNull(), F.lit(False)).otherwise(~dominated)
    return j.select(*df.columns, keep.alias(out))


def hypervolume_2d(front: DataFrame, x: str, y: str, ref: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """Area dominated by maximised 2-D points above ``ref``: walking x from
    high to low, each x adds its width times what its best y gains over all
    larger x. Points that are dominated or repeat add nothing, and the walk is
    a running maximum over ranges, so any number of points will do."""
    per_x = front.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(x).alias("_x")).agg(F.max(y).alias("_v"))
    walk = running(per_x, [F.col("_x").desc()], {"_before": ("max", "_v")}, (), block=RANGE, exclusive=True)
    floor = F.greatest(F.coalesce("_before", F.lit(float(ref[1]))), F.lit(float(ref[1])))
    area = F.greatest(F.col("_x") - F.lit(float(ref[0])), F.lit(0.0)) * (F.greatest(F.col("_v"), floor) - floor)
    return walk.agg(F.coalesce(F.sum(area), F.lit(0.0)).alias("hypervolume"))


def simplex_weights(df: DataFrame, key: str, m: int, seed) -> DataFrame:
    """m repeatable random weights per row, uniform on the simplex
    (normalised exponentials -ln(u))."""
    es = [-F.log(F.lit(1.0) - md5_unit(key, f"{seed}:{j}")) for j in range(m)]
    tot = es[0]
    for e in es[1:]:
        tot = tot + e
    return df.select(key, *[(e / tot).alias(f"w{j}") for j, e in enumerate(es)])


# ------------------------------------------------------------------ bandits
def arm_stats(log: DataFrame, entity: str, arm: str, reward: str) -> DataFrame:
    return log.groupBy(entity, arm).agg(F.count(reward).alias("pulls"), F.sum(reward).alias("total"),
                                        F.avg(reward).alias("mean"))


def _all_arms(stats: DataFrame, entity: str, arm: str) -> DataFrame:
    arms = stats.select(arm).distinct()
    ents = stats.select(entity).distinct()
    grid = ents.crossJoin(small(arms))  # the rows asked for: every entity with every arm
    return grid.join(stats, [entity, arm], "left").fillna({"pulls": 0, "total": 0.0})


def ucb1(stats: DataFrame, entity: str, arm: str) -> DataFrame:
    """UCB1 score ``mean + sqrt(2 ln t / n)`` per (entity, arm), t = the
    entity's total pulls; never-pulled arms score +inf and come first. Adds
    ``chosen`` for the best arm (arm name breaks ties)."""
    a = _all_arms(stats, entity, arm)
    t = F.sum("pulls").over(Window.partitionBy(entity))
    score = F.when(F.col("pulls") == 0, F.lit(math.inf)).otherwise(
        F.col("total") / F.col("pulls") + F.sqrt(F.lit(2.0) * F.log(F.greatest(t, F.lit(1))) / F.col("pulls")))
    s = a.withColumn("ucb", score)
    rk = F.row_number().over(Window.partitionBy(entity).orderBy(F.col("ucb").desc(), F.col(arm)))
    return s.withColumn("chosen", rk == 1)


def eps_greedy(stats: DataFrame, entity: str, arm: str, eps: float, seed) -> DataFrame:
    """Per entity: explore with probability eps (hash draw) picking an arm by
    a second hash draw, else the arm with the best mean (name breaks ties)."""
    a = _all_arms(stats, entity, arm).withColumn("_mean", F.when(F.col("pulls") > 0, F.col("total") / F.col("pulls")).otherwise(0.0))
    w = Window.partitionBy(entity)
    ordered = a.withColumn("_k", F.row_number().over(w.orderBy(arm)) - 1).withColumn("_n", F.count(F.lit(1)).over(w))
    greedy = F.row_number().over(w.orderBy(F.col("_mean").desc(), F.col(arm)))
    explore = md5_unit(entity, f"{seed}:e") < eps
    pick = F.floor(md5_unit(entity, f"{seed}:a") * F.col("_n"))
    chosen = F.when(explore, F.col("_k") == pick).otherwise(F.col("_g") == 1)
    return ordered.withColumn("_g", greedy).select(entity, arm, "pulls", explore.alias("explored"),
                                                   chosen.alias("chosen"))


def thompson_state(stats: DataFrame, entity: str, arm: str) -> DataFrame:
    """Beta posterior per arm: alpha = 1 + sum r, beta = 1 + sum (1 - r)."""
    alpha = F.lit(1.0) + F.col("total")
    beta = F.lit(1.0) + F.col("pulls") - F.col("total")
    return stats.select(entity, arm, "pulls", alpha.alias("alpha"), beta.alias("beta"),
                        (alpha / (alpha + beta)).alias("post_mean"),
                        (alpha * beta / ((alpha + beta) ** 2 * (alpha + beta + 1))).alias("post_var"))


def thompson_draw(state: DataFrame, entity: str, arm: str, seed: int) -> DataFrame:
    """One seeded Beta draw per (entity, arm) (NumPy in an Arrow-batched
    pandas UDF; the generator is seeded from a hash of the key, so draws do
    not depend on partitioning)."""

    @F.pandas_udf("double")
    def draw(a: pd.Series, b: pd.Series, k: pd.Series) -> pd.Series:
        out = np.empty(len(a))
        for i, (aa, bb, kk) in enumerate(zip(a, b, k)):
            out[i] = np.random.default_rng(int(kk)).beta(aa, bb)
        return pd.Series(out)

    key = F.conv(F.substring(F.md5(F.concat_ws(":", F.col(entity).cast("string"), F.col(arm), F.lit(str(seed)))),
                             1, 8), 16, 10).cast("long")
    return state.withColumn("draw", draw("alpha", "beta", key))


# ------------------------------------------------------------------ plates
#: Products of list lengths stop growing here; more reactions cannot be numbered.
MANY = 1 << 62


def _product(numbers: Column) -> Column:
    """Exact product of a few counts as a long, at most ``MANY``."""
    many = F.lit(MANY)
    return F.aggregate(numbers, F.lit(1).cast("long"), lambda a, n: F.when(a > F.floor(many / n), many).otherwise(a * n))


def worklist_coverage(stocks: DataFrame, category: str, stock: str, categories: Sequence[str], capacity: int) -> DataFrame:
    """What a worklist of ``capacity`` reactions leaves out: one row with the
    number of possible reactions, those scheduled and those left out."""
    n = (stocks.where(F.col(category).isin(list(categories))).groupBy(category)
         .agg(F.count(F.lit(1)).alias("_n")))
    total = n.agg(_product(F.collect_list("_n")).alias("possible"))
    return total.select("possible", F.least("possible", F.lit(capacity).cast("long")).alias("scheduled"),
                        F.greatest(F.col("possible") - capacity, F.lit(0).cast("long")).alias("left_out"))


def worklist(stocks: DataFrame, category: str, stock: str, volume: str, categories: Sequence[str],
             capacity: int, plate_size: int = 96) -> DataFrame:
    """One transfer row per (reaction, category).

    Reactions are all combinations of one stock per category, in
    lexicographic order of the categories' stock lists, truncated to
    ``capacity``. Reaction k picks, for category i, stock number
    ``(k // prod(n_j, j > i)) mod n_i`` - decoded per row, the product is
    never built; ``worklist_coverage`` says what the capacity leaves out. Each reaction gets a well (row-major, plates of
    ``plate_size``).
    """
    st = stocks.select(F.col(category).alias("category"), F.col(stock).alias("stock"), F.col(volume).alias("volume"))
    st = st.withColumn("_j", F.row_number().over(Window.partitionBy("category").orderBy("stock")) - 1)
    counts = st.groupBy("category").agg(F.count(F.lit(1)).alias("_n"))
    order = F.create_map(*[x for i, c in enumerate(categories) for x in (F.lit(c), F.lit(i))])
    counts = counts.withColumn("_ci", F.try_element_at(order, F.col("category"))).where(F.col("_ci").isNotNull())
    # radix of category i = product of the counts of categories after it
    wr = Window.orderBy(F.col("_ci").desc()).rowsBetween(Window.unboundedPreceding, -1)
    radix = counts.withColumn("_radix", _product(F.collect_list("_n").over(wr)))
    total = counts.agg(_product(F.collect_list("_n"))).scalar()
    n_react = F.least(total, F.lit(capacity).cast("bigint"))
    spark = stocks.sparkSession
    reactions = spark.range(capacity).where(F.col("id") < n_react).withColumnRenamed("id", "reaction")
    rx = reactions.crossJoin(F.broadcast(radix.select("category", "_ci", "_n", "_radix")))  # x categories (a few)
    rx = rx.withColumn("_j", (F.expr("reaction div _radix") % F.col("_n")).cast("int"))
    t = rx.join(st, ["category", "_j"])
    within = F.col("reaction") % plate_size
    letter = F.chr(F.lit(65) + (within / 12).cast("int"))
    return t.select("reaction", (F.col("reaction") / plate_size).cast("bigint").alias("plate"),
                    F.concat(letter, (within % 12 + 1).cast("string")).alias("well"),
                    "_ci", "category", "stock", "volume").withColumnRenamed("_ci", "step")


def reaction_worklist(transfers: DataFrame, reaction: str, step: str, category: str, stock: str, volume: str,
                      plate_size: int = 96) -> DataFrame:
    """One transfer row per given (reaction, step): every reaction of the table
    gets a well of its own, row-major in order of the reactions, on as many plates
    as it takes. Reactions are numbered by a running count over ranges."""
    wells = row_index(transfers.select(F.col(reaction).alias("reaction")).distinct(), ["reaction"])
    within = F.col("idx") % plate_size
    wells = wells.select("reaction", F.floor(F.col("idx") / plate_size).cast("bigint").alias("plate"),
                         F.concat(F.chr(F.lit(65) + (within / 12).cast("int")), (within % 12 + 1).cast("string")).alias("well"))
    t = transfers.select(F.col(reaction).alias("reaction"), F.col(step).alias("step"), F.col(category).alias("category"),
                         F.col(stock).alias("stock"), F.col(volume).alias("volume"))
    return t.join(wells, "reaction").select("reaction", "plate", "well", "step", "category", "stock", "volume")


def stock_consumption(wl: DataFrame) -> DataFrame:
    return wl.groupBy("category", "stock").agg(F.sum("volume").alias("total_volume"),
                                               F.count(F.lit(1)).alias("n_transfers"))


def schedule_estimate(wl: DataFrame, sec_per_action: float, split_over_sec: float) -> DataFrame:
    """Actions, seconds and whether the run should be split."""
    return wl.agg(F.count(F.lit(1)).alias("n_actions")).select(
        "n_actions", (F.col("n_actions") * F.lit(float(sec_per_action))).alias("seconds"),
        (F.col("n_actions") * F.lit(float(sec_per_action)) > F.lit(float(split_over_sec))).alias("split"))


# ------------------------------------------------------------------ simulation
def inject_quirks(df: DataFrame, id_col: str, val: str, shares: Mapping[str, float], seed) -> DataFrame:
    """Disjoint exact-size slices of rows (by hash rank): 'fail' -> 0,
    'low' -> x 0.5, 'boost' -> min(1, x * 1.2). Slice sizes are
    floor(share * n) in the order fail, low, boost."""
    from vialflow.operators.features import _rank_in_class
    r = _rank_in_class(df, id_col, None, seed)
    n = df.agg(F.count(F.lit(1))).scalar()
    a = F.floor(n * F.lit(shares.get("fail", 0.0)))
    b = a + F.floor(n * F.lit(shares.get("low", 0.0)))
    c = b + F.floor(n * F.lit(shares.get("boost", 0.0)))
    rk = F.col("_rank")
    quirk = F.when(rk <= a, "fail").when(rk <= b, "low").when(rk <= c, "boost")
    v = F.col(val)
    newv = (F.when(quirk == "fail", F.lit(0.0)).when(quirk == "low", v * 0.5)
            .when(quirk == "boost", F.least(F.lit(1.0), v * 1.2)).otherwise(v))
    return r.select(*[newv.alias(val) if c == val else F.col(c) for c in df.columns], quirk.alias("quirk"))


def reveal_positives(df: DataFrame, id_col: str, y: str, c: float, seed, out: str = "s") -> DataFrame:
    """Observed label s: a positive is revealed with probability c (hash draw)."""
    return df.withColumn(out, ((F.col(y) == 1) & (md5_unit(id_col, seed) < c)).cast("int"))


# ------------------------------------------------------------------ traces
def compare_strategies(log: DataFrame, method: str, order: Sequence, outcome: str,
                       budgets: Sequence[int], block: Column | str = RANGE) -> DataFrame:
    """Best outcome reached by each method within each budget (number of
    steps). Steps are distributed running counts per method; every budget is
    one conditional max in a single aggregate."""
    r = running(log.withColumn("_one", F.lit(1)), order, {"_step": ("count", "_one")}, [method], block)
    g = r.groupBy(method).agg(*[F.max(F.when(F.col("_step") <= b, F.col(outcome))).alias(f"b{b}") for b in budgets])
    long = g.select(method, F.explode(F.array(*[F.struct(F.lit(int(b)).alias("budget"), F.col(f"b{b}").alias("best"))
                                                for b in budgets])).alias("_r"))
    return long.select(method, "_r.budget", "_r.best")


def hv_trace(df: DataFrame, x: str, y: str, round_col: str) -> DataFrame:
    """2-D hypervolume (reference 0, 0; maximised) of all points seen up to
    each round. Each point is counted in every round from its own on (the
    round list is small); per round only the best y per distinct x is kept
    (partial aggregate). Walking x from high to low, each x adds its width times
    what its best y gains over all larger x, a running maximum over ranges, so a
    round with very many points is no single task's work."""
    rounds = df.select(round_col).distinct()
    pts = df.select(F.col(round_col).alias("_from"), F.col(x).cast("double").alias("_x"),
                    F.col(y).cast("double").alias("_y")).where(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    best = pts.groupBy("_from", "_x").agg(F.max("_y").alias("_y"))
    ex = best.join(small(rounds.withColumnRenamed(round_col, "round")), F.col("round") >= F.col("_from"))
    per = ex.groupBy("round", "_x").agg(F.max("_y").alias("_y"))
    walk = running(per, [F.col("_x").desc()], {"_before": ("max", "_y")}, ["round"], block=RANGE, exclusive=True)
    floor = F.greatest(F.coalesce("_before", F.lit(0.0)), F.lit(0.0))
    s = walk.select("round", (F.greatest(F.col("_x"), F.lit(0.0)) * (F.greatest(F.col("_y"), floor) - floor)).alias("_a"))
    return s.groupBy("round").agg(F.sum("_a").alias("hypervolume"))


def q_iterate(transitions: DataFrame, gamma: float, alpha: float, rounds: int) -> DataFrame:
    """Batch Q iteration on logged transitions (s, a, r, s2; s2 NULL at the
    end of an episode): Q(s,a) += alpha * mean over its transitions of
    (r + gamma * max_a' Q(s2, a') - Q(s,a)), starting from 0. The Q table is
    states x actions (small) and is joined back each round."""
    t = transitions
    q = t.select("s", "a").distinct().withColumn("q", F.lit(0.0))
    for _ in range(rounds):
        v = q.groupBy(F.col("s").alias("s2")).agg(F.max("q").alias("v"))
        upd = (t.join(v, "s2", "left").join(q, ["s", "a"])
               .groupBy("s", "a").agg(F.avg(F.col("r") + F.lit(gamma) * F.coalesce("v", F.lit(0.0)) - F.col("q")).alias("_d")))
        q = q.join(upd, ["s", "a"], "left").select("s", "a", (F.col("q") + F.lit(alpha) * F.coalesce("_d", F.lit(0.0))).alias("q"))
    return q


# ------------------------------------------------------------------ GP
def gp_score(observed: DataFrame, candidates: DataFrame, feats: Sequence[str], y: str, id_col: str,
             length: float = 0.5, signal: float = 1.0, noise: float = 1e-4) -> DataFrame:
    """Gaussian-process mean and sigma for every candidate (Matern 5/2 kernel,
    fixed hyperparameters, features expected on [0, 1]), for any number of
    observations: a random-feature model whose Gram matrix is summed on Spark
    (``operators.kernelfit``)."""
    return kernelfit.score(candidates, kernelfit.fit(observed, feats, y, length, signal, noise), feats, id_col)


def suggest(space: DataFrame, id_col: str, feats: Sequence[str], objectives: Mapping[str, float], b: int,
            seed, xi: float = 0.0) -> DataFrame:
    """Next batch of ``b`` untested points (iteration == -1).

    Without completed runs: the b smallest hash draws. Otherwise features are
    min-max scaled on the space, one GP per objective is fitted on the
    completed points, means and sigmas are scalarised with the weights, EI
    against the best observed scalar picks the batch (EI desc, id asc). A
    failing fit is an error.
    """
    from vialflow.operators.features import apply_minmax, fit_minmax
    done = space.where(F.col("iteration") >= 0)
    cand = space.where(F.col("iteration") == -1)
    random_pick = (cand.withColumn("_u", md5_unit(id_col, seed)).orderBy("_u", id_col).limit(b)
                   .select(id_col, F.lit("random").alias("method"), F.lit(None).cast("double").alias("ei")))
    if done.isEmpty():
        return random_pick
    mm = fit_minmax(space, feats)
    sc = apply_minmax(space.select(id_col, *feats, *objectives, "iteration"), mm, feats)
    preds = None
    for obj in objectives:
        obs = sc.where((F.col("iteration") >= 0) & F.col(obj).isNotNull())
        g = gp_score(obs, sc.where(F.col("iteration") == -1), feats, obj, id_col).select(
            id_col, F.col("mu").alias(f"mu_{obj}"), F.col("sigma").alias(f"sd_{obj}"))
        preds = g if preds is None else preds.join(g, id_col)
    s = preds.select(id_col, *scalarise(objectives, {o: f"mu_{o}" for o in objectives},
                                        {o: f"sd_{o}" for o in objectives}))
    best_expr = None
    for o, w in objectives.items():
        t = F.lit(float(w)) * F.col(o)
        best_expr = t if best_expr is None else best_expr + t
    best = done.agg(F.max(best_expr)).scalar()
    e = s.withColumn("ei", acquire("mu_s", "sigma_s", "ei", best, xi=xi))
    return (e.orderBy(F.col("ei").desc(), F.col(id_col).asc()).limit(b)
            .select(id_col, F.lit("gp_ei").alias("method"), "ei"))
