"""Properties of the model jobs that have no SQL twin."""

import random
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from vialflow.operators import models as K


def _points(spark, n=600, seed=0):
    rng = np.random.default_rng(seed)
    group = rng.integers(0, 3, n)
    a = group * 50.0 + rng.normal(0, 1, n)
    b = (group == 1) * 0.02 + rng.normal(0, 0.001, n)
    y = 3 * a - 200 * b + rng.normal(0, 0.1, n)
    rows = [(i, *map(float, r)) for i, r in enumerate(zip(a, b, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, y double"), np.column_stack([a, b, y]), group


def test_centres_are_member_means_in_own_units(spark):
    df, data, group = _points(spark)
    labels, centres = K.cluster_in_units(df, "id", ["a", "b"], 3, 1)
    got = {r["id"]: r["cluster"] for r in labels.collect()}
    for r in centres.collect():
        own = np.array([i for i, c in got.items() if c == r["cluster"]])
        assert r["size"] == len(own) and np.allclose([r["a"], r["b"]], data[own, :2].mean(0), rtol=1e-3, atol=1e-3)
        assert len(set(group[own])) == 1


def test_cluster_iterations_read_packed_points(spark, monkeypatch):
    """Spark ML picks the start only; centres and sizes are those of its own
    iterations from there, and rows with a null take no part."""
    rng = np.random.default_rng(5)
    data = rng.uniform(size=(3000, 2)) * [10.0, 500.0]
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(data)]
    df = spark.createDataFrame(rows + [(3000, None, 1.0), (3001, None, None)], "id long, a double, b double").repartition(4, "id")
    fits, fit = [], K.KMeans.fit
    monkeypatch.setattr(K.KMeans, "fit", lambda self, d: fits.append(self.getMaxIter()) or fit(self, d))
    labels, centres = K.cluster_in_units(df, "id", ["a", "b"], 4, 3)
    got = sorted((r["a"], r["b"], r["size"]) for r in centres.collect())
    assert fits == [0] and labels.count() == 3000 and {r["cluster"] for r in labels.collect()} == {0, 1, 2, 3}
    m = df.agg(F.avg("a"), F.avg("b"), F.stddev_pop("a"), F.stddev_pop("b")).first()
    z = K.assemble(df.select(((F.col("a") - m[0]) / m[2]).alias("a"), ((F.col("b") - m[1]) / m[3]).alias("b")), ["a", "b"])
    model = K.KMeans(k=4, seed=3, featuresCol="features", tol=1e-6, maxIter=100).fit(z)
    n = {r["prediction"]: r["count"] for r in model.transform(z).groupBy("prediction").count().collect()}
    want = sorted((c[0] * m[2] + m[0], c[1] * m[3] + m[1], n[i]) for i, c in enumerate(model.clusterCenters()))
    assert np.allclose(got, want, rtol=1e-9)


def test_member_sums_give_a_tied_point_to_the_first_centre():
    x = np.array([[0.0, -2.0, 3.0], [1.0, 0.0, 0.0]])
    block = pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary())], ["points"])
    run = K._member_sums(np.array([[-1.0, 0.0], [1.0, 0.0], [9.0, 9.0]]))
    total = np.array(next(run([block])).column(0)[0].as_py()).reshape(3, 3)
    assert total.tolist() == [[-2.0, 1.0, 2.0], [3.0, 0.0, 1.0], [0.0, 0.0, 0.0]]


def test_pca_is_fitted_on_train_only(spark):
    df, data, _ = _points(spark)
    train, test = df.where("id < 400"), df.where("id >= 400")
    scores, loadings, shares = K.pca_tables(train, test, ["a", "b", "y"], 2, "id")
    x = (data[:400] - data[:400].mean(0)) / data[:400].std(0)
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    assert np.allclose([r["share"] for r in shares.orderBy("component").collect()], (s ** 2 / (s ** 2).sum())[:2], atol=1e-6)
    load = {(r["feature"], r["component"]): r["loading"] for r in loadings.collect()}
    first = np.array([load[f, 1] for f in ("a", "b", "y")])
    assert np.isclose(abs(first @ vt[0]), 1, atol=1e-6)
    z = (data[400:] - data[:400].mean(0)) / data[:400].std(0)
    got = np.array([r["scores"] for r in scores.orderBy("id").collect()])
    assert np.allclose(np.abs(got), np.abs(z @ vt[:2].T), atol=1e-6)


def test_tree_report(spark):
    df = spark.createDataFrame([(i, float(i % 10), float(i % 3), 5.0 if i % 10 > 4 else 1.0) for i in range(200)],
                               "id long, x double, z double, y double")
    one = K.tree_report(df, df, ["z", "x"], "y", [1, 3]).collect()
    assert [(r["n_leaves"], r["root_feature"], r["test_error"]) for r in one] == [(2, "x", 0.0)] * 2
    assert 4 <= one[0]["root_threshold"] < 5
    two = K.tree_report(df.withColumn("y", (F.col("y") > 2).cast("double")), df.withColumn("y", (F.col("y") > 2).cast("double")),
                        ["z", "x"], "y", [2], kind="classes", impurity="entropy").first()
    assert two["root_feature"] == "x" and two["test_error"] == 0.0


def test_cv_picks_and_refits(spark):
    df, _, _ = _points(spark, 300)
    f = df.withColumn("fold", (F.col("id") % 3).cast("int"))
    best = K.cv_best(f, ["a", "b"], "y", "fold", [0.001, 1e6]).collect()
    assert {r["best_alpha"] for r in best} == {0.001}
    coef = {r["feature"]: r["coef"] for r in best}
    plain = {r["feature"]: r["coef"] for r in K.coefficients(K.linreg(df, ["a", "b"], "y", "ridge", 0.001), ["a", "b"]).collect()}
    assert coef == plain and abs(coef["a"] - 3) < 0.1


def test_pu_without_held_out_positives(spark):
    df = spark.createDataFrame([(i, float(i % 7), float(i < 3)) for i in range(60)], "id long, x double, s double")
    got = K.pu_scores(df, ["x"], "s", "id", holdout_frac=0.0).collect()
    assert all(0.0 <= r["py"] <= 1.0 and abs(r["py"] - min(1.0, r["ps"] / 0.5)) < 1e-9 for r in got)


def test_saved_model_scores_with_errors(spark):
    from vialflow.session import scratch_path
    rows = [(i, float(i % 7), float(i % 3), float(i % 7 > 3)) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, a double, b double, y double")
    path = scratch_path(spark, "model")
    model = K.logreg(df, ["a", "b"], "y")
    K.save_model(model, ["a", "b"], path)
    new = spark.createDataFrame([(1, 6.0, 1.0), (2, 0.0, 1.0), (3, None, 1.0), (4, float("nan"), None)], "id int, a double, b double")
    got = {r["id"]: r for r in K.score_saved(path, new, ["id"]).collect()}
    assert [got[i]["error"] for i in (1, 2, 3, 4)] == [None, None, "missing: a", "missing: a,b"]
    assert [got[i]["prediction"] for i in (1, 2, 3)] == [1.0, 0.0, None] and got[1]["p1"] > 0.5 and not got[3]["ok"]
    fresh = {r["id"]: r["p1"] for r in K.score(model, new, ["a", "b"], ["id"]).collect()}
    assert all(got[i]["p1"] == fresh[i] for i in fresh)
    short = K.score_saved(path, new.drop("b"), ["id"]).collect()
    assert {r["error"] for r in short} == {"no column: b"} and len(short) == 4


def test_binned_target_and_multinomial(spark):
    df = spark.createDataFrame([(i, float(i), float(-i)) for i in range(90)], "id int, x double, z double")
    d = K.binned_target(df, "x", 3)
    assert {r["label"]: r["count"] for r in d.groupBy("label").count().collect()} == {0.0: 30, 1.0: 30, 2.0: 30}
    p = K.multinomial(d, ["x"], "label").transform(K.assemble(d, ["x"]))
    assert p.where("prediction <> label").count() <= 6


def test_prior_of_labelled_positives(spark):
    rng = random.Random(2)
    rows = []
    for i in range(3000):
        y = rng.random() < 0.4
        rows.append((i, rng.gauss(3.0 if y else -3.0, 1.0), float(y and rng.random() < 0.5)))
    got = K.pu_scores(spark.createDataFrame(rows, "id int, x double, s double"), ["x"], "s", "id").first()
    # a fifth of the labelled positives is held out of the fit: 0.4 of the other 0.9
    assert abs(got["c"] - 0.4 / 0.9) < 0.06 and abs(got["prior"] - 0.4) < 0.06


def test_layer_grid_is_ordered(spark):
    rows = [(i, (i % 11) / 11, (i % 5) / 5, float((i % 11 > 5) == (i % 5 > 2))) for i in range(220)]
    df = spark.createDataFrame(rows, "id int, a double, b double, y double")
    got = K.mlp_grid(df, df, ["a", "b"], "y", [[1], [6], [6, 4]], seed=1).orderBy("place").collect()
    acc = [r["val_accuracy"] for r in got]
    assert acc == sorted(acc, reverse=True) and {r["layers"] for r in got} == {"1", "6", "6-4"} and acc[0] > 0.7


def test_cv_table_needs_no_fit_per_fold(spark, monkeypatch):
    """The sums give the errors of scikit-learn's ridge, without a model per fold."""
    df, data, _ = _points(spark, 120)
    monkeypatch.setattr(K, "linreg", None)
    got = {r["alpha"]: r["cv_rmse"] for r in K.cv_table(df.withColumn("fold", (F.col("id") % 3).cast("int")), ["a", "b"], "y", "fold",
                                                        [0.5, 100.0]).collect()}
    fold = np.arange(120) % 3
    for alpha, rmse in got.items():
        errors = []
        for f in range(3):
            x, y = data[fold != f, :2], data[fold != f, 2]
            c = x - x.mean(0)
            w = np.linalg.solve(c.T @ c + alpha * np.eye(2), c.T @ (y - y.mean()))
            errors.append(np.sqrt(np.mean((data[fold == f, 2] - y.mean() - (data[fold == f, :2] - x.mean(0)) @ w) ** 2)))
        assert np.isclose(rmse, np.mean(errors), rtol=1e-8)


def test_text_features_are_written_once(spark):
    """Fits read features from a written table, not the texts."""
    from vialflow.plans.models import _doc_feats
    assert not any("documents.parquet" in f for f in _doc_feats(spark, "/root/testdata/sf0.001").inputFiles())
