"""Aggregations and summaries (group statistics, describe, pivots, fits).

All of these are single ``groupBy`` jobs or a short chain of them, so Spark
runs a partial (map-side) aggregate before every shuffle: a key that holds a
third of the rows is combined inside each map task and never reaches one
reducer as raw rows. Exact quantiles come from counts per value summed along
ranges of the values (``window.exact_quantiles``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vialflow.functions.stats import rnd
from vialflow.operators.window import exact_quantiles


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def replicate_summary(df: DataFrame, key, val: str, digits: int = 6) -> DataFrame:
    """Mean, sample std (ddof 1) and count of ``val`` per key (NULL keys dropped)."""
    keys = _cols(key)
    clean = df.dropna(subset=keys)
    return clean.groupBy(*keys).agg(
        rnd(F.avg(val), digits).alias("mean"),
        rnd(F.stddev_samp(val), digits).alias("std"),
        F.count(val).alias("n"),
    )


_AGGS = {
    "sum": F.sum, "mean": F.avg, "avg": F.avg, "min": F.min, "max": F.max,
    "std": F.stddev_samp, "count": F.count, "median": F.median,
    "nunique": F.count_distinct,
}


def summarise(df: DataFrame, key, spec: Sequence[tuple[str, str, str]], digits: int = 4) -> DataFrame:
    """Named aggregation: ``spec`` is ``[(alias, fn, column), ...]``, rounded."""
    exprs = []
    for alias, fn, col in spec:
        e = _AGGS[fn](F.col(col))
        if fn not in ("count", "nunique"):
            e = F.round(e, digits)
        exprs.append(e.alias(alias))
    return df.groupBy(*_cols(key)).agg(*exprs)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Count per value, most frequent first, value ascending on ties."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(col).asc_nulls_last()))


def top_entities(df: DataFrame, col: str, n: int) -> DataFrame:
    """The ``n`` most frequent values of ``col`` (ties broken by value).

    Bounded by ``n`` rows, so callers may broadcast it.
    """
    return (df.where(F.col(col).isNotNull())
            .groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(col).asc())
            .limit(n))


def describe(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """count, mean, std, min, 25/50/75 % (linear interpolation), max per column.

    One scan computes the plain statistics of all columns; the wide row is
    then turned into one row per column. The quantiles count every column's
    values together, keyed by the column's name.
    """
    melted = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_x"))
                                           for c in cols])).alias("s")).select("s.*")
    quart = exact_quantiles(melted, "_x", (0.25, 0.5, 0.75), ["column"]).select("column", "_q")
    exprs = []
    for c in cols:
        x = F.col(c).cast("double")
        exprs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                  F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                  F.max(x).alias(f"{c}__max")]
    wide = df.agg(*exprs)
    parts = []
    for c in cols:
        parts.append(F.struct(
            F.lit(c).alias("column"),
            F.col(f"{c}__count").alias("count"),
            rnd(F.col(f"{c}__mean"), digits).alias("mean"),
            rnd(F.col(f"{c}__std"), digits).alias("std"),
            rnd(F.col(f"{c}__min"), digits).alias("min"),
            rnd(F.col(f"{c}__max"), digits).alias("max")))
    rows = wide.select(F.explode(F.array(*parts)).alias("s")).select("s.*").join(quart, "column", "left")
    return rows.select("column", "count", "mean", "std", "min", *[
        rnd(F.get("_q", F.lit(i)), digits).alias(n) for i, n in enumerate(("p25", "p50", "p75"))], "max")


def describe_cat(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, unique, top (most frequent, smallest value on ties), freq per column."""
    out = None
    for c in cols:
        vc = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("cnt"))
        one = vc.agg(
            F.sum("cnt").cast("bigint").alias("count"),
            F.count(F.lit(1)).cast("bigint").alias("unique"),
            F.min_by(F.col(c).cast("string"), F.struct(-F.col("cnt"), F.col(c))).alias("top"),
            F.max("cnt").cast("bigint").alias("freq"),
        ).select(F.lit(c).alias("column"), "count", "unique", "top", "freq")
        out = one if out is None else out.unionByName(one)
    return out


def pivot_mean(df: DataFrame, row, col: str, val: str, values: Sequence | None = None,
               digits: int = 6) -> DataFrame:
    """Mean of ``val`` by ``row`` x ``col``. Pass ``values`` to skip the
    distinct-values pass Spark otherwise runs to name the columns."""
    g = df.groupBy(*_cols(row))
    p = g.pivot(col, list(values) if values is not None else None).agg(F.avg(val))
    keep = _cols(row)
    return p.select(*keep, *[rnd(F.col(c), digits).alias(c) for c in p.columns if c not in keep])


def corr_matrix(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson correlation for every ordered pair of ``cols`` in one scan."""
    exprs = []
    pairs = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j < i:
                continue
            name = f"c_{i}_{j}"
            exprs.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(name))
            pairs.append((a, b, name))
            if i != j:
                pairs.append((b, a, name))
    wide = df.agg(*exprs)
    arr = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                             rnd(F.col(n), digits).alias("corr")) for a, b, n in pairs])
    return wide.select(F.explode(arr).alias("s")).select("s.*")


def histogram(df: DataFrame, col: str, bins: int, lo: Column | float | None = None,
              hi: Column | float | None = None, digits: int = 6) -> DataFrame:
    """Equal-width histogram on [lo, hi]; the last bin is closed.

    When ``lo``/``hi`` are not given they are the column min/max, computed by
    one global aggregate (a single row joined back as a scalar). Empty bins
    are reported with 0.
    """
    x = F.col(col).cast("double")
    spark = df.sparkSession
    # bounds are scalar subqueries: evaluated once, inlined, no join
    lo_c = df.agg(F.min(x)).scalar() if lo is None else F.lit(float(lo))
    hi_c = df.agg(F.max(x)).scalar() if hi is None else F.lit(float(hi))
    width = (hi_c - lo_c) / F.lit(float(bins))
    counted = (df.select(x.alias("_x"))
               .where((F.col("_x") >= lo_c) & (F.col("_x") <= hi_c))
               .select(F.when(F.col("_x") == hi_c, F.lit(bins - 1))
                       .otherwise(F.floor((F.col("_x") - lo_c) / width).cast("bigint"))
                       .alias("bin"))
               .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    edges = spark.range(bins).withColumnRenamed("id", "bin").select(
        "bin",
        rnd(lo_c + F.col("bin") * width, digits).alias("left"),
        rnd(lo_c + (F.col("bin") + 1) * width, digits).alias("right"))
    return (edges.join(counted, "bin", "left")
            .select("bin", "left", "right", F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")))


def box_stats(df: DataFrame, key, val: str, digits: int = 6) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers (most extreme points inside the fences),
    outlier count and mean per group."""
    keys = _cols(key)
    x = F.col(val).cast("double")
    base = df.select(*keys, x.alias("_v")).where(F.col("_v").isNotNull())
    quart = exact_quantiles(base, "_v", (0.25, 0.5, 0.75), keys).select(*keys, "_q")
    q = base.groupBy(*keys).agg(F.avg("_v").alias("_mean"), F.count(F.lit(1)).alias("n")).join(quart, keys)
    q = q.select(*keys, "n", "_mean", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                 F.col("_q")[2].alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    # stats are one row per group: the join back to rows is a broadcast when
    # AQE sees the small side, a skew-split sort-merge join otherwise.
    j = base.join(q.select(*keys, "q1", "q3", "iqr"), keys)
    lo_f = F.col("q1") - F.lit(1.5) * F.col("iqr")
    hi_f = F.col("q3") + F.lit(1.5) * F.col("iqr")
    w = j.groupBy(*keys).agg(
        F.min(F.when(F.col("_v") >= lo_f, F.col("_v"))).alias("whisker_lo"),
        F.max(F.when(F.col("_v") <= hi_f, F.col("_v"))).alias("whisker_hi"),
        F.sum(F.when((F.col("_v") < lo_f) | (F.col("_v") > hi_f), 1).otherwise(0)).cast("bigint").alias("n_outliers"))
    out = q.join(w, keys)
    return out.select(*keys, "n", *[rnd(F.col(c), digits).alias(c) for c in
                                   ("q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi")],
                      "n_outliers", rnd(F.col("_mean"), digits).alias("mean"))


def line_fit(df: DataFrame, x: str, y: str, by=None, digits: int = 6) -> DataFrame:
    """Least-squares ``y = slope*x + intercept`` (per group), with r2 and n."""
    exprs = [rnd(F.regr_slope(F.col(y), F.col(x)), digits).alias("slope"),
             rnd(F.regr_intercept(F.col(y), F.col(x)), digits).alias("intercept"),
             rnd(F.regr_r2(F.col(y), F.col(x)), digits).alias("r2"),
             F.regr_count(F.col(y), F.col(x)).alias("n")]
    if by:
        return df.groupBy(*_cols(by)).agg(*exprs)
    return df.agg(*exprs)


def fit_residuals(df: DataFrame, x: str, y: str, by, digits: int = 6) -> DataFrame:
    """Per group: residual RMSE and largest absolute residual of the
    group's own line fit (fit table joined back to the rows)."""
    keys = _cols(by)
    fit = df.groupBy(*keys).agg(F.regr_slope(F.col(y), F.col(x)).alias("_m"),
                                F.regr_intercept(F.col(y), F.col(x)).alias("_b"))
    r = (df.join(fit, keys)
         .select(*keys, (F.col(y) - (F.col("_m") * F.col(x) + F.col("_b"))).alias("_r")))
    return r.groupBy(*keys).agg(rnd(F.sqrt(F.avg(F.col("_r") * F.col("_r"))), 4).alias("rmse"),
                                rnd(F.max(F.abs("_r")), 4).alias("max_abs_residual"))


def general_condition(df: DataFrame, entity: str, conds: Sequence[str], val: str,
                      top_n: int = 10, min_cov: int = 8, digits: int = 6) -> DataFrame:
    """Conditions that work across entities.

    1. the ``top_n`` most frequent entities (bounded -> broadcast semi join);
    2. mean outcome per (condition, entity) - partial aggregate, one shuffle;
    3. per condition: coverage (entities), mean/median/min/max of the
       entity means, kept when coverage >= ``min_cov``; second shuffle is on
       the already-aggregated table.
    Sorted by coverage, mean, median (descending) then the condition.
    """
    conds = list(conds)
    top = top_entities(df, entity, top_n).select(entity)
    runs = df.join(F.broadcast(top), entity, "left_semi").dropna(subset=conds + [entity])
    per = runs.groupBy(*conds, entity).agg(F.avg(val).alias("_m"))
    out = per.groupBy(*conds).agg(
        F.count(F.lit(1)).alias("coverage"),
        F.avg("_m").alias("_mean"), F.median("_m").alias("_median"),
        F.min("_m").alias("_min"), F.max("_m").alias("_max"))
    out = out.where(F.col("coverage") >= min_cov).select(
        *conds, "coverage", rnd("_mean", digits).alias("mean_yield_all"),
        rnd("_median", digits).alias("median_yield"), rnd("_min", digits).alias("min_yield"),
        rnd("_max", digits).alias("max_yield"))
    return out.orderBy(F.col("coverage").desc(), F.col("mean_yield_all").desc(),
                       F.col("median_yield").desc(), *[F.col(c).asc() for c in conds])


def best_by_entity(df: DataFrame, entity: str, conds: Sequence[str], val: str,
                   digits: int = 6) -> DataFrame:
    """Best condition per entity by mean outcome (ties: smallest condition).

    Aggregated first, so the per-entity window only sees one row per distinct
    condition of that entity, never the raw runs.
    """
    conds = list(conds)
    per = (df.dropna(subset=conds + [entity]).groupBy(entity, *conds)
           .agg(F.avg(val).alias("_m"), F.count(F.lit(1)).alias("n_runs")))
    # ranked on the mean itself, to the digits that the order of summation cannot touch
    per = per.withColumns({"mean": rnd("_m", digits), "_true": F.round("_m", 12)})
    w = Window.partitionBy(entity).orderBy(F.col("_true").desc(), *[F.col(c).asc() for c in conds])
    return (per.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
            .select(entity, *conds, "mean", "n_runs"))


def best_epoch(logs: DataFrame, run: str, epoch: str, train: str, val: str,
               digits: int = 6) -> DataFrame:
    """Sparse training logs -> per run: best epoch by validation loss (earliest
    on ties), the final epoch and the last logged train loss. Train and validation values of
    one epoch arrive on different rows and are merged with ``max`` per epoch."""
    per = logs.groupBy(run, epoch).agg(F.max(train).alias("_tr"), F.max(val).alias("_va"))
    return per.groupBy(run).agg(
        F.min_by(F.col(epoch), F.struct(F.col("_va").isNull(), F.col("_va"), F.col(epoch))).alias("best_epoch"),
        rnd(F.min("_va"), digits).alias("best_val_loss"),
        F.max(epoch).alias("final_epoch"),
        rnd(F.max_by("_tr", F.when(F.col("_tr").isNotNull(), F.col(epoch))), digits).alias("last_train_loss"),
        F.count(F.lit(1)).alias("n_epochs"))


def latency_summary(df: DataFrame, key, dur: str, digits: int = 6) -> DataFrame:
    """Mean, exact p95 and count of a duration per group."""
    keys = _cols(key)
    p95 = exact_quantiles(df, dur, (0.95,), keys).select(*keys, rnd(F.col("_q")[0], digits).alias("p95"))
    return df.groupBy(*keys).agg(rnd(F.avg(dur), digits).alias("mean"), F.count(F.lit(1)).alias("n")).join(
        p95, keys, "left").select(*keys, "mean", "p95", "n")
