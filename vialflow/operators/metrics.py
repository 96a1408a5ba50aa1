"""Evaluation jobs: regression and classification metrics, curves, cluster
quality and agreement.

Every metric is one or two aggregates over the scored table (partial
aggregation before each shuffle). Curves are built from per-distinct-score
counts, and their cumulative sums use the block-wise running aggregate, so
no step ranks the whole table in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vialflow.functions.stats import rnd
from vialflow.functions.vectors import as_double
from vialflow.operators.window import RANGE, running
from vialflow.session import small


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def regression_metrics(df: DataFrame, y: str, yhat: str, by: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """MSE, RMSE, MAE and R^2 (1 - SSE / SST; SST = n * var_pop(y))."""
    e = F.col(y) - F.col(yhat)
    g = df.groupBy(*by) if by else df
    out = g.agg(F.avg(e * e).alias("_mse"), F.avg(F.abs(e)).alias("_mae"),
                F.sum(e * e).alias("_sse"), (F.var_pop(y) * F.count(y)).alias("_sst"),
                F.count(F.lit(1)).alias("n"))
    return out.select(*by, "n", rnd("_mse", digits).alias("mse"), rnd(F.sqrt("_mse"), digits).alias("rmse"),
                      rnd("_mae", digits).alias("mae"),
                      rnd(F.when(F.col("_sst") == 0, None).otherwise(F.lit(1.0) - F.col("_sse") / F.col("_sst")),
                          digits).alias("r2"))


def residuals(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Residual per row plus the parity-plot limits (common min/max of y and
    yhat) as scalar subqueries."""
    lo = df.agg(F.least(F.min(y), F.min(yhat))).scalar()
    hi = df.agg(F.greatest(F.max(y), F.max(yhat))).scalar()
    return df.select("*", (F.col(y) - F.col(yhat)).alias("residual"), lo.alias("parity_lo"), hi.alias("parity_hi"))


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)


def _bin_counts(y: Column, pred: Column):
    return (F.sum(F.when((y == 1) & (pred == 1), 1).otherwise(0)),
            F.sum(F.when((y == 0) & (pred == 1), 1).otherwise(0)),
            F.sum(F.when((y == 1) & (pred == 0), 1).otherwise(0)),
            F.sum(F.when((y == 0) & (pred == 0), 1).otherwise(0)))


def _from_counts(tp, fp, fn, tn, digits):
    prec = _safe_div(tp, tp + fp)
    rec = _safe_div(tp, tp + fn)
    f1 = _safe_div(2 * prec * rec, prec + rec)
    acc = _safe_div(tp + tn, tp + fp + fn + tn)
    return [rnd(acc, digits).alias("accuracy"), rnd(prec, digits).alias("precision"),
            rnd(rec, digits).alias("recall"), rnd(f1, digits).alias("f1")]


def binary_metrics(df: DataFrame, y: str, score: str, t: float = 0.5, digits: int = 6) -> DataFrame:
    """Accuracy, precision, recall, F1 at ``score >= t`` (0 when undefined)."""
    pred = (F.col(score) >= t).cast("int")
    tp, fp, fn, tn = _bin_counts(F.col(y), pred)
    c = df.agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"))
    return c.select(*[F.col(x).cast("bigint").alias(x) for x in ("tp", "fp", "fn", "tn")],
                    *_from_counts(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"), digits))


def threshold_sweep(df: DataFrame, y: str, score: str, ts: Sequence[float], digits: int = 6) -> DataFrame:
    """Binary metrics for every threshold in one scan: 4 conditional sums per
    threshold, then one row per threshold."""
    exprs = []
    for i, t in enumerate(ts):
        pred = (F.col(score) >= t).cast("int")
        for name, e in zip(("tp", "fp", "fn", "tn"), _bin_counts(F.col(y), pred)):
            exprs.append(e.alias(f"{name}_{i}"))
    wide = df.agg(*exprs)
    rows = F.array(*[F.struct(F.lit(float(t)).alias("threshold"),
                              *[F.col(f"{n}_{i}").cast("bigint").alias(n) for n in ("tp", "fp", "fn", "tn")])
                     for i, t in enumerate(ts)])
    long = wide.select(F.explode(rows).alias("r")).select("r.*")
    return long.select("threshold", "tp", "fp", "fn", "tn",
                       *_from_counts(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"), digits))


def confusion(df: DataFrame, y: str, yhat: str, digits: int = 6) -> DataFrame:
    """Counts for every (true, predicted) class pair including zeros, and the
    row-normalised share. Classes are the distinct labels (a small set)."""
    classes = df.select(F.col(y).alias("c")).union(df.select(F.col(yhat).alias("c"))).where(F.col("c").isNotNull()).distinct()
    grid = classes.select(F.col("c").alias("true")).crossJoin(small(classes.select(F.col("c").alias("pred"))))
    cnt = df.groupBy(F.col(y).alias("true"), F.col(yhat).alias("pred")).agg(F.count(F.lit(1)).alias("count"))
    j = grid.join(cnt, ["true", "pred"], "left").withColumn("count", F.coalesce("count", F.lit(0)).cast("bigint"))
    tot = F.sum("count").over(Window.partitionBy("true"))
    return j.select("true", "pred", "count", rnd(_safe_div(F.col("count"), tot), digits).alias("row_share"))


def class_report(df: DataFrame, y: str, yhat: str, digits: int = 6) -> DataFrame:
    """Per class precision, recall, F1, support, plus a 'macro avg' row."""
    classes = df.select(F.col(y).cast("string").alias("cls")).union(
        df.select(F.col(yhat).cast("string").alias("cls"))).where(F.col("cls").isNotNull()).distinct()
    tp = df.where(F.col(y) == F.col(yhat)).groupBy(F.col(y).cast("string").alias("cls")).agg(F.count(F.lit(1)).alias("tp"))
    sup = df.groupBy(F.col(y).cast("string").alias("cls")).agg(F.count(F.lit(1)).alias("support"))
    npred = df.groupBy(F.col(yhat).cast("string").alias("cls")).agg(F.count(F.lit(1)).alias("npred"))
    j = classes.join(tp, "cls", "left").join(sup, "cls", "left").join(npred, "cls", "left").fillna(0)
    prec = _safe_div(F.col("tp"), F.col("npred"))
    rec = _safe_div(F.col("tp"), F.col("support"))
    per = j.select("cls", prec.alias("precision"), rec.alias("recall"),
                   _safe_div(2 * prec * rec, prec + rec).alias("f1"), F.col("support").cast("bigint").alias("support"))
    macro = per.agg(F.lit("macro avg").alias("cls"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                    F.sum("support").cast("bigint").alias("support"))
    out = per.unionByName(macro)
    return out.select("cls", *[rnd(c, digits).alias(c) for c in ("precision", "recall", "f1")], "support")


def _score_counts(df: DataFrame, y: str, score: str) -> DataFrame:
    return df.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("s")).agg(
        F.sum(F.when(F.col(y) == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(y) == 1, 0).otherwise(1)).alias("neg"))


def roc(df: DataFrame, y: str, score: str, digits: int = 6) -> DataFrame:
    """ROC points (one per distinct score, thresholds descending): rows with
    score >= threshold are predicted positive."""
    c = _score_counts(df, y, score)
    P = c.agg(F.sum("pos")).scalar()
    N = c.agg(F.sum("neg")).scalar()
    r = running(c, [F.col("s").desc()], {"_tp": ("sum", "pos"), "_fp": ("sum", "neg")}, (),
                block=RANGE)
    return r.select(F.col("s").alias("threshold"), rnd(_safe_div(F.col("_tp"), P), digits).alias("tpr"),
                    rnd(_safe_div(F.col("_fp"), N), digits).alias("fpr"))


def auc(df: DataFrame, y: str, score: str, digits: int = 6) -> DataFrame:
    """ROC AUC with tied scores counted half (Mann-Whitney form, equal to the
    trapezoid under the ROC curve): sum over scores of
    pos(s) * (negatives below s + neg(s) / 2) / (P * N)."""
    c = _score_counts(df, y, score)
    r = running(c, ["s"], {"_neg_le": ("sum", "neg")}, (), block=RANGE)
    term = F.col("pos") * (F.col("_neg_le") - F.col("neg") + F.col("neg") / 2.0)
    out = r.agg(F.sum(term).alias("_u"), F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    return out.select(rnd(_safe_div(F.col("_u"), F.col("_p") * F.col("_n")), digits).alias("auc"),
                      F.col("_p").cast("bigint").alias("n_pos"), F.col("_n").cast("bigint").alias("n_neg"))


def pr_curve(df: DataFrame, y: str, score: str, digits: int = 6) -> DataFrame:
    """Precision/recall per distinct score threshold (descending)."""
    c = _score_counts(df, y, score)
    P = c.agg(F.sum("pos")).scalar()
    r = running(c, [F.col("s").desc()], {"_tp": ("sum", "pos"), "_fp": ("sum", "neg")}, (),
                block=RANGE)
    return r.select(F.col("s").alias("threshold"),
                    rnd(_safe_div(F.col("_tp"), F.col("_tp") + F.col("_fp")), digits).alias("precision"),
                    rnd(_safe_div(F.col("_tp"), P), digits).alias("recall"),
                    F.col("pos"))


def average_precision(df: DataFrame, y: str, score: str, digits: int = 6) -> DataFrame:
    """AP = sum over thresholds of (R_n - R_{n-1}) * P_n = sum pos(s)/P * P(s)."""
    pr = pr_curve(df, y, score, digits=12)
    P = pr.agg(F.sum("pos")).scalar()
    return pr.agg(rnd(F.sum(_safe_div(F.col("pos"), P) * F.col("precision")), digits).alias("average_precision"))


def inertia(df: DataFrame, vec: str, label: str, centers: DataFrame, center_vec: str = "centroid",
            digits: int = 6) -> DataFrame:
    """Sum of squared distances to the assigned centre, per label and total
    (label NULL). Centres are one row per label (a small table)."""
    from vialflow.functions.vectors import sq_euclid
    j = df.join(centers.select(label, center_vec), label)
    d = j.select(label, sq_euclid(vec, center_vec).alias("_d2"))
    per = d.groupBy(label).agg(F.sum("_d2").alias("_s"), F.count(F.lit(1)).alias("n"))
    tot = per.agg(F.lit(None).cast(per.schema[label].dataType).alias(label), F.sum("_s").alias("_s"),
                  F.sum("n").alias("n"))
    return per.unionByName(tot).select(label, rnd("_s", digits).alias("inertia"), F.col("n").cast("bigint").alias("n"))


def silhouette_sq(df: DataFrame, id_col: str, vec: str, label: str, digits: int = 6) -> DataFrame:
    """Silhouette per row with squared Euclidean dissimilarity, exact and
    without pairs (the decomposition Spark's ClusteringEvaluator uses):

    mean_j ||x - y_j||^2 over a cluster = ||x||^2 - 2 x.S/n + Q/n, with S the
    vector sum and Q the sum of squared norms of the cluster. a(i) excludes
    the point itself (divide by n - 1); clusters of one point score 0.
    Cluster statistics are one row per cluster (bounded by the label count)
    and reach every row as one array via a one-row broadcast.
    """
    x = as_double(vec)
    e = df.select(id_col, label, x.alias("_x"))
    pe = e.select(label, F.posexplode("_x").alias("_pos", "_v"))
    sums = pe.groupBy(label, "_pos").agg(F.sum("_v").alias("_s"))
    svec = sums.groupBy(label).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_s"))), lambda s: s["_s"]).alias("S"))
    qn = e.groupBy(label).agg(F.count(F.lit(1)).alias("n"),
                              F.sum(F.aggregate(F.transform("_x", lambda v: v * v), F.lit(0.0), lambda a, b: a + b)).alias("Q"))
    stats = svec.join(qn, label)
    allc = stats.agg(F.collect_list(F.struct(F.col(label).alias("c"), "S", "n", "Q")).alias("_cl"))
    j = e.crossJoin(F.broadcast(allc))  # one row holding the cluster table
    nx = F.aggregate(F.transform("_x", lambda v: v * v), F.lit(0.0), lambda a, b: a + b)

    def mean_d(cl):
        dot = F.aggregate(F.zip_with(F.col("_x"), cl["S"], lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        return cl["n"] * nx - 2.0 * dot + cl["Q"]  # sum of squared distances

    own = F.filter("_cl", lambda cl: cl["c"] == F.col(label))[0]
    a = F.when(own["n"] <= 1, None).otherwise(mean_d(own) / (own["n"] - 1))
    others = F.transform(F.filter("_cl", lambda cl: cl["c"] != F.col(label)), lambda cl: mean_d(cl) / cl["n"])
    b = F.array_min(others)
    s = F.when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(
        F.when(F.greatest(a, b) == 0, F.lit(0.0)).otherwise((b - a) / F.greatest(a, b)))
    return j.select(id_col, label, rnd(s, digits).alias("silhouette"))


def cluster_agreement(df: DataFrame, a: str, b: str, digits: int = 6) -> DataFrame:
    """Adjusted Rand index and NMI (arithmetic normalisation) of two labelings
    from the contingency table."""
    n_ab = df.groupBy(a, b).agg(F.count(F.lit(1)).cast("double").alias("nij"))
    n_a = df.groupBy(a).agg(F.count(F.lit(1)).cast("double").alias("ai"))
    n_b = df.groupBy(b).agg(F.count(F.lit(1)).cast("double").alias("bj"))
    N = df.agg(F.count(F.lit(1)).cast("double")).scalar()

    def c2(x):
        return x * (x - 1) / 2.0

    sij = n_ab.agg(F.sum(c2(F.col("nij")))).scalar()
    sa = n_a.agg(F.sum(c2(F.col("ai")))).scalar()
    sb = n_b.agg(F.sum(c2(F.col("bj")))).scalar()
    ha = n_a.agg(-F.sum(F.col("ai") / N * F.log(F.col("ai") / N))).scalar()
    hb = n_b.agg(-F.sum(F.col("bj") / N * F.log(F.col("bj") / N))).scalar()
    mi_t = (n_ab.join(n_a, a).join(n_b, b)
            .agg(F.sum(F.col("nij") / N * F.log(N * F.col("nij") / (F.col("ai") * F.col("bj"))))).scalar())
    spark = df.sparkSession
    expected = sa * sb / c2(N)
    ari = F.when((sa + sb) / 2.0 - expected == 0, F.lit(1.0)).otherwise((sij - expected) / ((sa + sb) / 2.0 - expected))
    nmi = F.when((ha + hb) == 0, F.lit(1.0)).otherwise(mi_t / ((ha + hb) / 2.0))
    return spark.range(1).select(rnd(ari, digits).alias("ari"), rnd(nmi, digits).alias("nmi"))


def class_balance(df: DataFrame, y: str, digits: int = 6) -> DataFrame:
    """Count and share of every class."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.groupBy(y).agg(F.count(F.lit(1)).alias("n")).select(
        y, "n", rnd(F.col("n") / total, digits).alias("share"))


def prediction_sample(df: DataFrame, id_col: str, y: str, yhat: str, n: int, seed) -> DataFrame:
    """Repeatable sample of n predictions with a correct flag."""
    from vialflow.operators.features import sample_n
    s = sample_n(df, id_col, n, seed)
    return s.select(id_col, y, yhat, (F.col(y) == F.col(yhat)).alias("correct"))


LOG2 = math.log(2)
