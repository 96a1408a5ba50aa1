"""Models as table jobs: fit with Spark ML (distributed training), score to
tables, and the model-selection utilities that are plain aggregates.

Objective matching (scikit-learn conventions, see SURVEY T2-T5):
* ridge: ``regParam = alpha * sigma_y / n`` with ``standardization=False``
  (population sigma for the normal solver);
* lasso: ``regParam = alpha, elasticNetParam = 1``;
* logistic C: ``regParam = 1 / (C * n)``, ``standardization=False``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import (DecisionTreeClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark import StorageLevel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vialflow.functions.hashing import md5_unit
from vialflow.operators.window import RANGE, exact_quantiles, running


def assemble(df: DataFrame, feats: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(feats), outputCol=out, handleInvalid="skip").transform(df)


def _fit(estimator, train: DataFrame, feats: Sequence[str], label: str):
    """Fit on the assembled training set, persisted (memory and disk) for the
    duration of the fit: iterative optimisers pass over it many times and
    must not recompute upstream features on every pass."""
    data = assemble(train, feats).select("features", label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return estimator.fit(data)
    finally:
        data.unpersist()


def linreg(train: DataFrame, feats: Sequence[str], y: str, kind: str = "ols", alpha: float = 0.0):
    """Linear model: 'ols', 'ridge' or 'lasso' with scikit-learn's objective."""
    n = train.count()
    if kind == "ols":
        lr = LinearRegression(featuresCol="features", labelCol=y, solver="normal", regParam=0.0)
    elif kind == "ridge":
        sigma = train.agg(F.stddev_pop(y)).first()[0] or 1.0
        lr = LinearRegression(featuresCol="features", labelCol=y, solver="normal", standardization=False,
                              regParam=alpha * sigma / n, elasticNetParam=0.0)
    elif kind == "lasso":
        lr = LinearRegression(featuresCol="features", labelCol=y, standardization=False, regParam=alpha,
                              elasticNetParam=1.0, maxIter=200, tol=1e-9)
    else:
        raise ValueError(kind)
    return _fit(lr, train, feats, y)


def coefficients(model, feats: Sequence[str]) -> DataFrame:
    """Coefficient table sorted by magnitude (intercept last)."""
    spark = SparkSession.getActiveSession()
    rows = [(f, float(c), abs(float(c))) for f, c in zip(feats, model.coefficients.toArray())]
    rows.append(("intercept", float(model.intercept), -1.0))
    return spark.createDataFrame(rows, "feature string, coef double, magnitude double").orderBy(F.col("magnitude").desc())


def logreg(train: DataFrame, feats: Sequence[str], y: str, C: float = 1.0):
    n = train.count()
    lr = LogisticRegression(featuresCol="features", labelCol=y, regParam=1.0 / (C * n),
                            standardization=False, maxIter=200, tol=1e-8)
    return _fit(lr, train, feats, y)


def score(model, df: DataFrame, feats: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Scored rows with the positive-class probability (classifiers) or the
    prediction, plus audit columns: features used, an ok flag, and for rows that
    cannot be scored an error that names the absent columns or missing values."""
    feats = list(feats)
    absent = [f for f in feats if f not in df.columns]
    bad = [F.when(F.col(f).isNull() | F.isnan(F.col(f).cast("double")), F.lit(f)) for f in feats if f not in absent]
    error = (F.lit("no column: " + ",".join(absent)) if absent else
             F.nullif(F.concat(F.lit("missing: "), F.concat_ws(",", *bad)), F.lit("missing: ")))
    d = df.withColumn("error", error)
    audit = lambda ok: [F.lit(",".join(feats)).alias("features_used"), F.lit(ok).alias("ok"), "error"]
    is_classifier = hasattr(model, "numClasses")
    cols = ["prediction"] + ["p1"] * is_classifier
    left = d.where("error is not null").select(*keep, *[F.lit(None).cast("double").alias(c) for c in cols], *audit(False))
    if absent:
        return left
    good = model.transform(assemble(d.where("error is null"), feats))
    if is_classifier:
        good = good.withColumn("p1", vector_to_array("probability")[1])
    return good.select(*keep, *cols, *audit(True)).unionByName(left)


def save_model(model, feats: Sequence[str], path: str) -> None:
    """A fitted model with the names of its features, for later batches."""
    from pyspark.ml import PipelineModel
    PipelineModel([VectorAssembler(inputCols=list(feats), outputCol="features"), model]).write().overwrite().save(path)


def score_saved(path: str, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``score`` with a model that ``save_model`` has written."""
    from pyspark.ml import PipelineModel
    assembler, model = PipelineModel.load(path).stages
    return score(model, df, assembler.getInputCols(), keep)


def binned_target(df: DataFrame, target: str, bins: int, out: str = "label") -> DataFrame:
    """``df`` with the target's class: 0 .. bins - 1 between exact quantiles."""
    cuts = exact_quantiles(df, target, [i / bins for i in range(1, bins)]).first()["_q"]
    return df.withColumn(out, sum((F.when(F.col(target) > c, 1.0).otherwise(0.0) for c in sorted(set(cuts))), F.lit(0.0)))


def multinomial(train: DataFrame, feats: Sequence[str], y: str, reg: float = 0.0):
    """Multinomial logistic regression on classes 0, 1, 2, ..."""
    return _fit(LogisticRegression(featuresCol="features", labelCol=y, family="multinomial", regParam=reg, maxIter=200), train, feats, y)


def mlp_grid(train: DataFrame, valid: DataFrame, feats: Sequence[str], y: str, grid: Sequence[Sequence[int]], seed: int = 0) -> DataFrame:
    """``layers, val_accuracy, n_weights, place``: a fit per list of hidden layer
    widths, best first (ties: fewer weights, then the order of the grid)."""
    rows = []
    for i, hidden in enumerate(grid):  # one Spark fit per grid point
        m = mlp_classifier(train, feats, y, hidden, seed)
        acc = m.transform(assemble(valid, feats)).agg(F.avg((F.col("prediction") == F.col(y)).cast("double"))).first()[0]
        rows.append((-(acc or 0.0), len(m.weights), i, "-".join(map(str, hidden))))
    return train.sparkSession.createDataFrame([(name, -acc, n, k + 1) for k, (acc, n, _, name) in enumerate(sorted(rows))],
                                              "layers string, val_accuracy double, n_weights int, place int")


def tree(train: DataFrame, feats: Sequence[str], y: str, depth: int, min_leaf: int = 1,
         impurity: str = "gini", forest: int = 0, seed: int = 0):
    if forest:
        m = RandomForestClassifier(featuresCol="features", labelCol=y, numTrees=forest, maxDepth=depth,
                                   minInstancesPerNode=min_leaf, impurity=impurity, seed=seed)
    else:
        m = DecisionTreeClassifier(featuresCol="features", labelCol=y, maxDepth=depth,
                                   minInstancesPerNode=min_leaf, impurity=impurity, seed=seed)
    return _fit(m, train, feats, y)


def importances(model, feats: Sequence[str]) -> DataFrame:
    spark = SparkSession.getActiveSession()
    imp = model.featureImportances.toArray()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(feats, imp)], "feature string, importance double")


def best_splits(df: DataFrame, feats: Sequence[str], y: str) -> DataFrame:
    """``feature, threshold, decrease, place``: per feature the exact threshold
    with the largest Gini decrease (rows with x <= t go left; the smallest
    threshold on ties), best feature first (ties: order of ``feats``). A feature
    with fewer than two values has no threshold and no row.

    Features are melted once into counts per (feature, value) (partial
    aggregate); one prefix pass over these gives every candidate's impurity, so
    raw rows are neither sorted nor read once per feature.
    """
    feats = list(feats)
    melted = df.select(F.col(y).alias("_y"), F.explode(F.array(*[F.struct(F.lit(i).alias("_f"), F.col(f).cast("double").alias("t"))
                                                                 for i, f in enumerate(feats)])).alias("_m"))
    c = melted.select("_y", "_m._f", "_m.t").where(F.col("t").isNotNull()).groupBy("_f", "t").agg(
        F.sum("_y").alias("pos"), F.count(F.lit(1)).alias("cnt"))
    r = running(c, ["t"], {"lp": ("sum", "pos"), "ln": ("sum", "cnt")}, ["_f"], block=RANGE)
    tot = c.groupBy("_f").agg(F.sum("pos").alias("P"), F.sum("cnt").alias("N"))  # a row per feature
    j = r.join(F.broadcast(tot), "_f").where(F.col("ln") < F.col("N"))

    def gini(p, n):
        q = F.when(n > 0, p / n).otherwise(0.0)
        return F.lit(1.0) - q * q - (F.lit(1.0) - q) * (F.lit(1.0) - q)

    parent = gini(F.col("P"), F.col("N"))
    left = gini(F.col("lp"), F.col("ln"))
    right = gini(F.col("P") - F.col("lp"), F.col("N") - F.col("ln"))
    dec = parent - (F.col("ln") / F.col("N")) * left - ((F.col("N") - F.col("ln")) / F.col("N")) * right
    best = j.select("_f", "t", F.round(dec, 9).alias("decrease")).groupBy("_f").agg(
        F.min_by("t", F.struct(-F.col("decrease"), F.col("t"))).alias("threshold"), F.max("decrease").alias("decrease"))
    name = F.element_at(F.array(*[F.lit(f) for f in feats]), F.col("_f") + 1)
    place = F.row_number().over(Window.orderBy(F.col("decrease").desc(), "_f"))  # a row per feature
    return best.select(name.alias("feature"), "threshold", "decrease", place.alias("place"))


def best_split(df: DataFrame, x: str, y: str) -> DataFrame:
    """``threshold, decrease`` of one feature (NULL where it has one value)."""
    return best_splits(df, [x], y).agg(F.first("threshold").alias("threshold"), F.first("decrease").alias("decrease"))


def ensemble_mean(preds: DataFrame, id_col: str, pred: str) -> DataFrame:
    return preds.groupBy(id_col).agg(F.avg(pred).alias("mean_pred"), F.count(F.lit(1)).alias("n_models"))


def vote(preds: DataFrame, id_col: str, label: str, prob: str) -> DataFrame:
    """Hard vote (most frequent label, the lower label on ties) and soft vote
    (mean probability >= 0.5)."""
    counts = preds.groupBy(id_col, label).agg(F.count(F.lit(1)).alias("_n"))
    hard = counts.groupBy(id_col).agg(F.min_by(label, F.struct(-F.col("_n"), F.col(label))).alias("hard_vote"))
    soft = preds.groupBy(id_col).agg(F.avg(prob).alias("mean_prob"))
    return hard.join(soft, id_col).select(id_col, "hard_vote", "mean_prob",
                                         (F.col("mean_prob") >= 0.5).cast("int").alias("soft_vote"))


_SUMS = ("n", "x", "y", "xx", "xy", "yy")


def _sums(train: Column | None = None) -> list[Column]:
    """Sufficient statistics of a line through (``_x``, ``_y``), of the rows where
    ``train`` holds."""
    x, y = F.col("_x"), F.col("_y")
    terms = (F.lit(1.0), x, y, x * x, x * y, y * y)
    return [F.coalesce(F.sum(t if train is None else F.when(train, t)), F.lit(0.0)) for t in terms]


def _line(s: Column) -> tuple[Column, Column]:
    """Slope and intercept from a struct of sums."""
    d = s["n"] * s["xx"] - s["x"] * s["x"]
    m = F.when(d != 0, (s["n"] * s["xy"] - s["x"] * s["y"]) / F.when(d != 0, d))
    return m, (s["y"] - m * s["x"]) / s["n"]


def _rmse(s: Column, m: Column, b: Column) -> Column:
    """Root mean squared error of a line on the rows behind a struct of sums."""
    sse = s["yy"] - 2 * m * s["xy"] - 2 * b * s["y"] + m * m * s["xx"] + 2 * m * b * s["x"] + b * b * s["n"]
    return F.when(s["n"] > 0, F.sqrt(F.greatest(sse, F.lit(0.0)) / F.when(s["n"] > 0, s["n"])))


def _centred(df: DataFrame, id_col: str, x: str, y: str) -> DataFrame:
    """``_id, _x, _y`` around the means, so that sums of squares keep their
    digits (errors of a fitted line do not depend on the shift)."""
    d = df.select(F.col(id_col).alias("_id"), F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).dropna()
    mx, my = d.agg(F.avg("_x"), F.avg("_y")).first()
    return d.select("_id", (F.col("_x") - F.lit(mx or 0.0)).alias("_x"), (F.col("_y") - F.lit(my or 0.0)).alias("_y"))


def split_study(df: DataFrame, id_col: str, x: str, y: str, fractions: Sequence[float],
                seeds: Sequence[int]) -> DataFrame:
    """One-feature least squares over a grid of (train fraction, seed): test RMSE
    per split, then mean and population std over seeds.

    One pass and no row more than the table has: a row's draw under a seed puts it
    into one of the gaps between the fractions, each (seed, gap) sums a line's
    sufficient statistics, and every split's train and test sums are sums of
    gaps. Fit and error come from the sums."""
    d = _centred(df, id_col, x, y)
    cuts = sorted(set(map(float, fractions)))
    gaps = [(s, g) for s in seeds for g in range(len(cuts) + 1)]
    for s in dict.fromkeys(seeds):
        u = F.conv(F.substring(F.md5(F.concat(F.col("_id").cast("string"), F.lit(f":{int(s)}"))), 1, 8), 16, 10).cast("double") / 4294967296.0
        d = d.withColumn(f"_g{int(s)}", sum((F.when(u >= c, 1).otherwise(0) for c in cuts), F.lit(0)))
    one = d.agg(*[F.struct(*[v.alias(k) for k, v in zip(_SUMS, _sums(F.col(f"_g{int(s)}") == g))]).alias(f"s{i}")
                  for i, (s, g) in enumerate(gaps)])
    at = {key: F.col(f"s{i}") for i, key in enumerate(gaps)}

    def total(keys):
        return F.struct(*[sum((at[k][f] for k in keys), F.lit(0.0)).alias(f) for f in _SUMS])
    rows = F.array(*[F.struct(F.lit(float(c)).alias("frac"), total([(s, g) for g in range(cuts.index(float(c)) + 1)]).alias("train"),
                              total([(s, g) for g in range(cuts.index(float(c)) + 1, len(cuts) + 1)]).alias("test"))
                     for c in map(float, fractions) for s in seeds])
    m, b = _line(F.col("train"))
    err = one.select(F.explode(rows).alias("_r")).select("_r.*").withColumns({"_m": m, "_b": b}).select(
        "frac", _rmse(F.col("test"), F.col("_m"), F.col("_b")).alias("rmse"))
    return err.where("rmse is not null").groupBy("frac").agg(F.avg("rmse").alias("rmse_mean"), F.stddev_pop("rmse").alias("rmse_std"),
                                                             F.count(F.lit(1)).alias("n_splits"))


def learning_curve(df: DataFrame, id_col: str, x: str, y: str, sizes: Sequence[float], seed: int,
                   test_frac: float = 0.2) -> DataFrame:
    """Test RMSE by training-set size: a fixed hash test set; nested training
    sets are hash prefixes of the rest (u below each size share). One pass: the
    sums of the test set and of each training set are conditional aggregates, and
    fit and error come from the sums."""
    d = _centred(df, id_col, x, y).select("_x", "_y", (md5_unit("_id", seed) < test_frac).alias("_test"),
                                          md5_unit("_id", f"{seed}:size").alias("_v"))
    sizes = [float(s) for s in sizes]
    struct = lambda keep: F.struct(*[v.alias(k) for k, v in zip(_SUMS, _sums(keep))])
    one = d.agg(struct(F.col("_test")).alias("test"), *[struct(~F.col("_test") & (F.col("_v") < s)).alias(f"s{i}")
                                                        for i, s in enumerate(sizes)])
    rows = one.select("test", F.explode(F.array(*[F.struct(F.lit(s).alias("size"), F.col(f"s{i}").alias("train"))
                                                  for i, s in enumerate(sizes)])).alias("_r")).select("test", "_r.*")
    m, b = _line(F.col("train"))
    rows = rows.where(F.col("train.n") > 0).withColumns({"_m": m, "_b": b})
    return rows.select("size", F.col("train.n").cast("bigint").alias("n_train"),
                       _rmse(F.col("test"), F.col("_m"), F.col("_b")).alias("rmse"))


def kmeans(df: DataFrame, vec: str, k: int, seed: int):
    d = df.withColumn("features", array_to_vector(F.col(vec)))
    return KMeans(k=k, seed=seed, featuresCol="features").fit(d), d


#: Points that are compared with the centres at a time; their scores stay in a core's cache.
_NEAR = 2000


def _packed(batches):
    """Per Arrow batch one row: the bytes of its points, a line per column."""
    for b in batches:
        x = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns])
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary())], ["points"])


def _member_sums(centres: np.ndarray):
    """Per task one row: for each centre the sum of the packed points nearest to it
    (the first centre on ties), then their number."""
    k, d = centres.shape
    half = (centres ** 2).sum(1)[:, None] / 2

    def run(batches):
        total = np.zeros((k, d + 1))
        for b in batches:
            for block in b.column(0):
                x = np.frombuffer(block.as_buffer()).reshape(d, -1)
                for at in range(0, x.shape[1], _NEAR):
                    p = x[:, at:at + _NEAR]
                    closeness = centres @ p - half  # (|p|^2 - distance^2) / 2
                    own = closeness == closeness.max(0)
                    if own.sum() > p.shape[1]:
                        own &= own.cumsum(0) == 1
                    total[:, :d] += own.astype(float) @ p.T
                    total[:, d] += own.sum(1)
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["total"])
    return run


def _lloyd(points: DataFrame, centres: np.ndarray, tol: float, steps: int) -> np.ndarray:
    """Spark ML's iterations over packed points: each centre moves to the mean of its
    points (without points it stays) until none moves further than ``tol``. A pass
    returns k * (d + 1) numbers per task."""
    k, d = centres.shape
    for _ in range(steps):
        rows = points.mapInArrow(_member_sums(centres), "total array<double>").collect()
        total = sum((np.array(r["total"]).reshape(k, d + 1) for r in rows), np.zeros((k, d + 1)))
        moved = np.where(total[:, d:] > 0, total[:, :d] / np.maximum(total[:, d:], 1), centres)
        far = ((moved - centres) ** 2).sum(1).max()
        centres = moved
        if far <= tol * tol:
            break
    return centres


def cluster_in_units(df: DataFrame, id_col: str, feats: Sequence[str], k: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """KMeans on standardised columns: ``id, cluster`` per row, and the centres
    in the columns' own units with the cluster sizes.

    Spark ML picks the starting centres (k-means||). The iterations pass over the
    rows up to 100 times, so they read them packed, 8 bytes per number and without
    the id, and Spark ML's rows of vectors are not kept."""
    stats = df.agg(*[F.avg(f).alias(f"m_{f}") for f in feats], *[F.stddev_pop(f).alias(f"s_{f}") for f in feats]).first()
    scaled = [((F.col(f) - stats[f"m_{f}"]) / (stats[f"s_{f}"] or 1.0)).alias(f) for f in feats]
    rows = df.select(id_col, *scaled).dropna(subset=list(feats))
    start = KMeans(k=k, seed=seed, featuresCol="features", maxIter=0, solver="block").fit(
        assemble(rows.select(*feats), feats).select("features")).clusterCenters()
    points = rows.select(*feats).mapInArrow(_packed, "points binary").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = _lloyd(points, np.array(start), 1e-6, 100)
    finally:
        points.unpersist()
    far = F.array(*[sum(((F.col(f) - v) * (F.col(f) - v) for f, v in zip(feats, c)), F.lit(0.0)) for c in found.tolist()])
    labels = rows.select(id_col, (F.array_position(far, F.array_min(far)) - 1).cast("int").alias("cluster"))
    centres = df.sparkSession.createDataFrame(
        [(i, *[float(v * (stats[f"s_{f}"] or 1.0) + stats[f"m_{f}"]) for f, v in zip(feats, c)])
         for i, c in enumerate(found)],
        "cluster int, " + ", ".join(f"`{f}` double" for f in feats))
    sizes = labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    return labels, centres.join(sizes, "cluster")


def pca_tables(train: DataFrame, other: DataFrame, feats: Sequence[str], k: int, id_col: str) -> tuple[DataFrame, ...]:
    """PCA of standardised columns fitted on ``train``: scores of ``other``
    (scaled by the training statistics), loadings, and explained shares."""
    stats = train.agg(*[F.avg(f).alias(f"m_{f}") for f in feats], *[F.stddev_pop(f).alias(f"s_{f}") for f in feats]).first()
    scale = lambda d: assemble(d.select(id_col, *[((F.col(f) - stats[f"m_{f}"]) / (stats[f"s_{f}"] or 1.0)).alias(f)
                                                  for f in feats]), feats)
    model = PCA(k=k, inputCol="features", outputCol="pcs").fit(scale(train))
    spark = train.sparkSession
    loadings = spark.createDataFrame([(f, i + 1, float(model.pc.toArray()[j, i])) for j, f in enumerate(feats) for i in range(k)],
                                     "feature string, component int, loading double")
    shares = spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(model.explainedVariance.toArray())],
                                   "component int, share double")
    return model.transform(scale(other)).select(id_col, vector_to_array("pcs").alias("scores")), loadings, shares


def best_threshold(df: DataFrame, y: str, score: str) -> DataFrame:
    """Threshold (score >= t is positive) with the best F1, the largest one on
    ties: counts per distinct score, summed from the highest score down."""
    c = df.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("t")).agg(
        F.sum(F.when(F.col(y) == 1, 1).otherwise(0)).alias("pos"), F.count(F.lit(1)).alias("n"))
    total = c.agg(F.sum("pos")).scalar()
    r = running(c, [F.col("t").desc()], {"tp": ("sum", "pos"), "picked": ("sum", "n")}, (), block=RANGE)
    r = r.withColumn("f1", 2 * F.col("tp") / (F.col("picked") + total))
    return r.agg(F.max(F.struct("f1", "t")).alias("b")).select(F.col("b.t").alias("threshold"), F.col("b.f1").alias("f1"))


def tree_report(train: DataFrame, test: DataFrame, feats: Sequence[str], y: str, depths: Sequence[int],
                kind: str = "regression", impurity: str | None = None, trees: int = 1, seed: int = 0) -> DataFrame:
    """One row per depth: number of leaves (summed over trees), root feature
    and threshold (single trees), and test error (RMSE or error rate)."""
    import re

    from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
    rows = []
    for depth in depths:
        how = {"featuresCol": "features", "labelCol": y, "maxDepth": depth, "seed": seed}
        if kind == "regression":
            est = DecisionTreeRegressor(**how) if trees == 1 else RandomForestRegressor(numTrees=trees, **how)
        else:
            how["impurity"] = impurity or "gini"
            est = DecisionTreeClassifier(**how) if trees == 1 else RandomForestClassifier(numTrees=trees, **how)
        model = _fit(est, train, feats, y)
        wrong = ((F.col("prediction") - F.col(y)) ** 2 if kind == "regression"
                 else (F.col("prediction") != F.col(y)).cast("double"))
        error = model.transform(assemble(test, feats)).agg(F.avg(wrong)).first()[0]
        root = re.search(r"If \(feature (\d+) <= ([-0-9.Ee]+)\)", model.toDebugString) if trees == 1 else None
        leaves = len(re.findall(r"Predict:", model.toDebugString))
        rows.append((depth, leaves, feats[int(root[1])] if root else None, float(root[2]) if root else None,
                     None if error is None else float(error ** 0.5 if kind == "regression" else error)))
    return train.sparkSession.createDataFrame(
        rows, "depth int, n_leaves int, root_feature string, root_threshold double, test_error double")


def pca_scores(df: DataFrame, vec: str, k: int, id_col: str) -> DataFrame:
    """PCA on centred vectors (ML PCA does not centre): scores per row and
    the explained share per component."""
    dim = df.select(F.size(vec)).first()[0]
    means = df.select(F.posexplode(vec).alias("_p", "_x")).groupBy("_p").agg(F.avg("_x").alias("_m"))
    mvec = means.agg(F.transform(F.array_sort(F.collect_list(F.struct("_p", "_m"))), lambda s: s["_m"]).alias("_mu"))
    c = df.crossJoin(F.broadcast(mvec)).select(
        id_col, array_to_vector(F.zip_with(F.col(vec), F.col("_mu"), lambda a, b: a.cast("double") - b)).alias("features"))
    model = PCA(k=min(k, dim), inputCol="features", outputCol="pcs").fit(c)
    return model.transform(c).select(id_col, vector_to_array("pcs").alias("scores")), model


def pu_scores(df: DataFrame, feats: Sequence[str], s: str, id_col: str, holdout_frac: float = 0.2,
              seed: int = 0) -> DataFrame:
    """PU learning under SCAR: fit p(s=1|x), estimate c = mean p(s=1|x) over
    held-out labelled positives (0.5 if there are none, never below 1e-6), then
    p(y=1|x) = clip(p(s)/c, 0, 1). ``c`` and the class prior that follows from it
    are columns of the result: labelled rows of the fit / c, at most all of its
    rows, plus the held-out positives, as a share of all rows."""
    u = md5_unit(id_col, seed)
    d = df.withColumn("_hold", (F.col(s) == 1) & (u < holdout_frac))
    model = logreg(d.where(~F.col("_hold")), feats, s)
    scored = model.transform(assemble(d, feats)).withColumn("ps", vector_to_array("probability")[1])
    c = scored.where("_hold").agg(F.greatest(F.coalesce(F.avg("ps"), F.lit(0.5)), F.lit(1e-6))).scalar()
    known, rest, n = d.agg(F.count(F.when((F.col(s) == 1) & ~F.col("_hold"), 1)), F.count(F.when(~F.col("_hold"), 1)),
                           F.count(F.lit(1))).first()
    return scored.select(id_col, s, "ps", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("ps") / c)).alias("py"),
                         c.alias("c"), ((F.least(F.lit(float(rest)), F.lit(float(known)) / c) + F.lit(float(n - rest))) / F.lit(float(n or 1))).alias("prior"))


def pick_prior(df: DataFrame, score: str) -> DataFrame:
    """Prior-guided threshold: prior = mean score clipped to [0.01, 0.99];
    keep rows with score >= the (1 - prior) quantile."""
    # the prior is one number
    prior = df.agg(F.greatest(F.lit(0.01), F.least(F.lit(0.99), F.avg(score)))).first()[0]
    thr = exact_quantiles(df, score, (1.0 - prior,)).select(F.col("_q")[0]).scalar()
    return df.where(F.col(score) >= thr)



def gbt_regressor(train: DataFrame, feats: Sequence[str], y: str, iters: int = 30, depth: int = 3, seed: int = 0):
    from pyspark.ml.regression import GBTRegressor
    return _fit(GBTRegressor(featuresCol="features", labelCol=y, maxIter=iters, maxDepth=depth, seed=seed),
                train, feats, y)


def mlp_classifier(train: DataFrame, feats: Sequence[str], y: str, hidden: Sequence[int], seed: int = 0):
    """MLP on standardised features (population std, fitted on train)."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    n_classes = int(train.agg(F.max(y)).first()[0]) + 1
    layers = [len(feats), *hidden, n_classes]
    return _fit(MultilayerPerceptronClassifier(featuresCol="features", labelCol=y, layers=layers, seed=seed,
                                               maxIter=200), train, feats, y)


def bisecting(df: DataFrame, vec: str, k: int, seed: int):
    from pyspark.ml.clustering import BisectingKMeans
    d = df.withColumn("features", array_to_vector(F.col(vec)))
    return BisectingKMeans(k=k, seed=seed, featuresCol="features").fit(d), d


def _ridge(g: np.ndarray, alpha: float) -> tuple[np.ndarray, float]:
    """Coefficients and intercept of scikit-learn's ridge from the sums of
    products of (1, features, target)."""
    mean = g[0] / g[0, 0]
    c = g - g[0, 0] * np.outer(mean, mean)
    w = np.linalg.lstsq(c[1:-1, 1:-1] + alpha * np.eye(len(c) - 2), c[1:-1, -1], rcond=None)[0]
    return w, float(mean[-1] - mean[1:-1] @ w)


def cv_table(df: DataFrame, feats: Sequence[str], y: str, fold: str, alphas: Sequence[float]) -> DataFrame:
    """Cross-validated RMSE per ridge alpha, mean and std over folds. One pass over
    the rows that have all values: each fold sums the products of features and
    target around their means; the sums of the other folds give a fit, those of the
    fold its error."""
    cols = [*feats, y]
    d = df.select(fold, *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"_x{i}")
                          for i, c in enumerate(cols)]).dropna(subset=[f"_x{i}" for i in range(len(cols))])
    d = d.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # any point near the means does: sums of squares keep their digits
        mid = d.agg(*[F.avg(f"_x{i}") for i in range(len(cols))]).first()
        v = [F.lit(1.0), *[F.col(f"_x{i}") - F.lit(m or 0.0) for i, m in enumerate(mid)]]
        at = [(i, j) for i in range(len(v)) for j in range(i, len(v))]
        sums = d.groupBy(fold).agg(*[F.sum(v[i] * v[j]) for i, j in at]).orderBy(fold).collect()  # a row per fold
    finally:
        d.unpersist()
    gram = {}
    for row in sums:
        g = np.zeros((len(v), len(v)))
        for (i, j), s in zip(at, row[1:]):
            g[i, j] = g[j, i] = s
        gram[row[0]] = g
    rows = []
    for a in alphas:
        for f, g in gram.items():
            w, b = _ridge(sum(o for k, o in gram.items() if k != f), a)
            e = np.r_[-b, -w, 1.0]
            rows.append((float(a), int(f), float(np.sqrt(max(e @ g @ e, 0.0) / g[0, 0]))))
    t = df.sparkSession.createDataFrame(rows, "alpha double, fold int, rmse double")
    return t.groupBy("alpha").agg(F.avg("rmse").alias("cv_rmse"), F.stddev_pop("rmse").alias("cv_std"))


def cv_best(df: DataFrame, feats: Sequence[str], y: str, fold: str, alphas: Sequence[float]) -> DataFrame:
    """The alpha with the smallest cross-validated RMSE (the largest alpha on
    ties) and the coefficients of the refit on all rows."""
    df = df.select(*feats, y, fold).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        best = cv_table(df, feats, y, fold, alphas).orderBy("cv_rmse", F.col("alpha").desc()).first()
        refit = coefficients(linreg(df, feats, y, "ridge", best["alpha"]), feats)
    finally:
        df.unpersist()
    return refit.select(F.lit(best["alpha"]).alias("best_alpha"), F.lit(best["cv_rmse"]).alias("cv_rmse"), "feature", "coef")


def permutation_importance(model, df: DataFrame, feats: Sequence[str], y: str, id_col: str,
                           repeats: int, seed: int) -> DataFrame:
    """Accuracy drop when one feature's values are permuted across rows.
    The permutation pairs the i-th row in id order with the i-th row in a
    hash order (two distributed row numbers joined on the rank)."""
    from vialflow.operators.window import row_index
    spark = df.sparkSession

    def acc(d):
        return model.transform(assemble(d, feats)).agg(
            F.avg((F.col("prediction") == F.col(y)).cast("double"))).first()[0]

    base = acc(df)
    a = row_index(df, [id_col], out="_r")
    rows = []
    for f in feats:
        for r in range(repeats):
            h = md5_unit(id_col, f"{seed}:{f}:{r}")
            src = row_index(df.select(id_col, F.col(f).alias("_pv")).withColumn("_h", h), ["_h", id_col], out="_r")
            perm = a.drop(f).join(src.select("_r", F.col("_pv").alias(f)), "_r")
            rows.append((f, r, float(base - acc(perm))))
    t = spark.createDataFrame(rows, "feature string, repeat int, drop double")
    return t.groupBy("feature").agg(F.avg("drop").alias("importance"), F.stddev_pop("drop").alias("std"))


def self_train(labelled: DataFrame, unlabelled: DataFrame, feats: Sequence[str], y: str,
               hi: float = 0.70, lo: float = 0.30):
    """Self-training: fit, pseudo-label unlabelled rows with p >= hi as 1 and
    p <= lo as 0, append them and refit. Returns (model, n_pseudo)."""
    m1 = logreg(labelled, feats, y)
    scored = m1.transform(assemble(unlabelled, feats)).withColumn("_p", vector_to_array("probability")[1])
    pseudo = scored.where((F.col("_p") >= hi) | (F.col("_p") <= lo)).select(
        *[F.col(c) for c in feats], (F.col("_p") >= hi).cast("double").alias(y))
    n_pseudo = pseudo.count()
    m2 = logreg(labelled.select(*feats, y).unionByName(pseudo), feats, y)
    return m2, n_pseudo


def poisson1(u: "F.Column") -> "F.Column":
    """Poisson(1) draw from a uniform by the inverse CDF. Beyond 18 the CDF
    is 1 in double precision, so no draw is cut."""
    import math as _m
    cdf, expr, acc = 0.0, None, None
    for k in range(19):
        cdf += _m.exp(-1.0) / _m.factorial(k)
        cond = u < F.lit(cdf)
        expr = F.when(cond, F.lit(k)) if expr is None else expr.when(cond, F.lit(k))
    return expr.otherwise(F.lit(19))


def oob_score(df: DataFrame, feats: Sequence[str], y: str, id_col: str, n_trees: int, depth: int,
              seed: int) -> DataFrame:
    """Out-of-bag accuracy of a bagged tree ensemble: tree t sees each row
    with a Poisson(1) weight from a hash of (id, t); rows with weight 0 are
    out of bag for t. Each row's OOB prediction is the majority vote (lower
    class on ties) of the trees that did not see it."""
    from pyspark.ml.classification import DecisionTreeClassifier
    votes = None
    for t in range(n_trees):
        w = poisson1(md5_unit(id_col, f"{seed}:{t}")).cast("double")
        d = df.withColumn("_w", w)
        m = DecisionTreeClassifier(featuresCol="features", labelCol=y, weightCol="_w", maxDepth=depth, seed=seed + t)
        data = assemble(d.where(F.col("_w") > 0), feats).select("features", y, "_w").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            model = m.fit(data)
        finally:
            data.unpersist()
        oob = model.transform(assemble(d.where(F.col("_w") == 0), feats)).select(id_col, F.col("prediction").alias("vote"))
        votes = oob if votes is None else votes.unionByName(oob)
    counts = votes.groupBy(id_col, "vote").agg(F.count(F.lit(1)).alias("_n"))
    pred = counts.groupBy(id_col).agg(F.min_by("vote", F.struct(-F.col("_n"), F.col("vote"))).alias("oob_pred"))
    j = pred.join(df.select(id_col, y), id_col)
    return j.agg(F.avg((F.col("oob_pred") == F.col(y)).cast("double")).alias("oob_accuracy"),
                 F.count(F.lit(1)).alias("n_scored"))
