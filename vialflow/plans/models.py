"""Section K: models as table jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from vialflow.functions.hashing import md5_unit
from vialflow.functions.stats import rnd
from vialflow.operators import features as FE
from vialflow.operators import models as K
from vialflow.plans.columns import _u
from vialflow.plans.evaluation import _SCORED_SQL, scored_docs
from vialflow.plans.registry import register
from vialflow.session import scratch_path, written
from vialflow.sources.tables import Tables

_LI_KEY = "concat(l_orderkey::VARCHAR, ':', l_linenumber::VARCHAR)"


def _li_split(spark, sf):
    li = Tables(spark, sf).lineitem
    key = F.concat_ws(":", "l_orderkey", "l_linenumber")
    return li.select(key.alias("rid"), "l_quantity", "l_discount", "l_tax", "l_extendedprice",
                     (md5_unit(key, 42) < 0.8).alias("train"))


@register("linreg_one_feature", sql=f"""
WITH d AS (SELECT l_quantity AS x, l_extendedprice AS y, {_u(_LI_KEY, 42)} < 0.8 AS train FROM lineitem),
f AS (SELECT regr_slope(y, x) AS m, regr_intercept(y, x) AS b FROM d WHERE train)
SELECT round(m, 4) AS slope, round(b, 4) AS intercept,
       round((SELECT sqrt(avg((y - (m * x + b)) ^ 2)) FROM d WHERE NOT train), 4) AS test_rmse FROM f
""")
def linreg_one_feature(spark, sf):
    d = _li_split(spark, sf)
    m = K.linreg(d.where("train"), ["l_quantity"], "l_extendedprice", "ols")
    slope, intercept = float(m.coefficients[0]), float(m.intercept)
    test = d.where(~F.col("train"))
    rmse = test.agg(F.sqrt(F.avg((F.col("l_extendedprice") - (F.lit(slope) * F.col("l_quantity") + F.lit(intercept))) ** 2))
                    .alias("r"))
    return rmse.select(F.round(F.lit(slope), 4).alias("slope"), F.round(F.lit(intercept), 4).alias("intercept"),
                       F.round("r", 4).alias("test_rmse"))


@register("ridge_lasso_path")
def ridge_lasso_path(spark, sf):
    """Ridge and lasso coefficients over an alpha path (scikit-learn objectives)."""
    d = _li_split(spark, sf).where("train")
    feats = ["l_quantity", "l_discount", "l_tax"]
    out = None
    for kind in ("ridge", "lasso"):
        for a in (0.1, 1.0, 10.0):
            c = K.coefficients(K.linreg(d, feats, "l_extendedprice", kind, a), feats)
            c = c.select(F.lit(kind).alias("kind"), F.lit(a).alias("alpha"), "feature", "coef")
            out = c if out is None else out.unionByName(c)
    return out


def _text_feats(t):
    """Features of all documents, written once: fits, folds and scores pass over
    these few numbers many times, over the texts once."""
    return written(t.documents.select("doc_id", *FE.text_features("text")), "text-features")


def _doc_feats(spark, sf):
    t = Tables(spark, sf)
    return written(_text_feats(t).join(t.labels, "doc_id").withColumn("train", md5_unit("doc_id", 5) < 0.75), "doc-features")


_DOC_FEATS = ["n_chars", "n_words", "digit_share", "upper_share", "punct_share", "mean_word_len"]


@register("logreg_scores")
def logreg_scores(spark, sf):
    """L2 logistic regression (C = 1) on text features; test rows scored."""
    d = _doc_feats(spark, sf).withColumn("toxic", F.col("toxic").cast("double"))
    m = K.logreg(d.where("train"), _DOC_FEATS, "toxic", C=1.0)
    return K.score(m, d.where(~F.col("train")), _DOC_FEATS, ["doc_id", "toxic"])


@register("tree_grid")
def tree_grid(spark, sf):
    """Decision-tree depth x min-leaf grid with validation accuracy."""
    d = _doc_feats(spark, sf).withColumn("quality", F.col("quality").cast("double"))
    tr, va = d.where("train"), d.where(~F.col("train"))
    rows = []
    for depth in (2, 4):
        for leaf in (1, 5):
            m = K.tree(tr, _DOC_FEATS, "quality", depth, leaf)
            acc = m.transform(K.assemble(va, _DOC_FEATS)).agg(F.avg((F.col("prediction") == F.col("quality")).cast("double"))).first()[0]
            rows.append((depth, leaf, float(acc or 0.0), m.numNodes))
    return spark.createDataFrame(rows, "max_depth int, min_leaf int, val_accuracy double, n_nodes int")


@register("forest_importance")
def forest_importance(spark, sf):
    """Random-forest feature importances."""
    d = _doc_feats(spark, sf).withColumn("quality", F.col("quality").cast("double"))
    m = K.tree(d.where("train"), _DOC_FEATS, "quality", 5, 1, forest=20, seed=7)
    return K.importances(m, _DOC_FEATS)


_SPLIT_SQL = f"""
WITH s AS {_SCORED_SQL},
c AS (SELECT score AS t, sum(y) AS pos, count(*) AS cnt FROM s WHERE score IS NOT NULL GROUP BY score),
tot AS (SELECT sum(pos) AS P, sum(cnt) AS N FROM c),
r AS (SELECT t, sum(pos) OVER (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lp,
             sum(cnt) OVER (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ln FROM c),
g AS (SELECT t, ln, N,
   (1 - (P / N) ^ 2 - (1 - P / N) ^ 2)
   - (ln / N) * (1 - (lp / ln) ^ 2 - (1 - lp / ln) ^ 2)
   - ((N - ln) / N) * (1 - ((P - lp) / (N - ln)) ^ 2 - (1 - (P - lp) / (N - ln)) ^ 2) AS dec FROM r, tot WHERE ln < N)
SELECT arg_min(t, (-round(dec, 9), t)) AS threshold, max(round(dec, 9)) AS decrease FROM g
"""


_SPLIT_FEATS = {"score": "score", "n_chars": "n_chars", "n_lines": "length(text) - length(replace(text, chr(10), ''))"}


def _splits_sql():
    melted = " UNION ALL ".join(
        f"SELECT {i} AS f, '{name}' AS feature, ({expr})::DOUBLE AS t, s.y FROM {_SCORED_SQL} s JOIN documents d USING (doc_id)"
        for i, (name, expr) in enumerate(_SPLIT_FEATS.items()))
    return f"""
WITH a AS ({melted}),
c AS (SELECT f, feature, t, sum(y) AS pos, count(*) AS cnt FROM a WHERE t IS NOT NULL GROUP BY ALL),
r AS (SELECT *, sum(pos) OVER w AS lp, sum(cnt) OVER w AS ln, sum(pos) OVER (PARTITION BY f) AS P, sum(cnt) OVER (PARTITION BY f) AS N
      FROM c WINDOW w AS (PARTITION BY f ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
g AS (SELECT f, feature, t, round(
   (1 - (P / N) ^ 2 - (1 - P / N) ^ 2) - (ln / N) * (1 - (lp / ln) ^ 2 - (1 - lp / ln) ^ 2)
   - ((N - ln) / N) * (1 - ((P - lp) / (N - ln)) ^ 2 - (1 - (P - lp) / (N - ln)) ^ 2), 9) AS dec FROM r WHERE ln < N),
b AS (SELECT f, feature, arg_min(t, (-dec, t)) AS threshold, max(dec) AS decrease FROM g GROUP BY f, feature)
SELECT feature, threshold, decrease, row_number() OVER (ORDER BY decrease DESC, f)::INTEGER AS place FROM b"""


@register("best_splits", sql=_splits_sql())
def best_splits(spark, sf):
    """Best threshold of three document features at once."""
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    d = scored_docs(spark, sf).select("doc_id", "score", "y").join(
        Tables(spark, sf).documents.select("doc_id", "n_chars", lines.alias("n_lines")), "doc_id")
    return K.best_splits(d, list(_SPLIT_FEATS), "y")


@register("best_split", sql=_SPLIT_SQL)
def best_split(spark, sf):
    return K.best_split(scored_docs(spark, sf), "score", "y")


_ORD_PREDS = """(SELECT o_orderkey, 'status' AS model, avg(o_totalprice) OVER (PARTITION BY o_orderstatus) AS pred FROM orders
  UNION ALL SELECT o_orderkey, 'priority', avg(o_totalprice) OVER (PARTITION BY o_orderpriority) FROM orders
  UNION ALL SELECT o_orderkey, 'global', avg(o_totalprice) OVER () FROM orders)"""


def _ord_preds(spark, sf):
    o = Tables(spark, sf).orders
    a = o.groupBy("o_orderstatus").agg(F.avg("o_totalprice").alias("pred"))
    b = o.groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("pred"))
    g = o.agg(F.avg("o_totalprice")).scalar()
    return (o.join(a, "o_orderstatus").select("o_orderkey", F.lit("status").alias("model"), "pred")
            .unionByName(o.join(b, "o_orderpriority").select("o_orderkey", F.lit("priority").alias("model"), "pred"))
            .unionByName(o.select("o_orderkey", F.lit("global").alias("model"), g.alias("pred"))))


@register("ensemble_mean", sql=f"""
SELECT o_orderkey, round(avg(pred), 4) AS mean_pred, count(*) AS n_models FROM {_ORD_PREDS} p GROUP BY o_orderkey
""")
def ensemble_mean(spark, sf):
    e = K.ensemble_mean(_ord_preds(spark, sf), "o_orderkey", "pred")
    return e.select("o_orderkey", rnd("mean_pred", 4).alias("mean_pred"), "n_models")


_VOTE_PREDS = f"""(SELECT doc_id, 'junk' AS model, least(1.0, score * 10) AS prob FROM {_SCORED_SQL} s
  UNION ALL SELECT d.doc_id, 'length', CASE WHEN n_chars > 3000 THEN 0.7 ELSE 0.3 END FROM documents d JOIN labels USING (doc_id)
  UNION ALL SELECT d.doc_id, 'hashes', CASE WHEN contains(text, '###') THEN 0.8 ELSE 0.2 END FROM documents d JOIN labels USING (doc_id))"""


def _vote_preds(spark, sf):
    s = scored_docs(spark, sf)
    t = Tables(spark, sf)
    dl = t.documents.join(t.labels.select("doc_id"), "doc_id")
    return (s.select("doc_id", F.lit("junk").alias("model"), F.least(F.lit(1.0), F.col("score") * 10).alias("prob"))
            .unionByName(dl.select("doc_id", F.lit("length").alias("model"),
                                   F.when(F.col("n_chars") > 3000, 0.7).otherwise(0.3).alias("prob")))
            .unionByName(dl.select("doc_id", F.lit("hashes").alias("model"),
                                   F.when(F.col("text").contains("###"), 0.8).otherwise(0.2).alias("prob"))))


@register("vote", sql=f"""
WITH p AS (SELECT doc_id, model, prob, (prob >= 0.5)::INTEGER AS label FROM {_VOTE_PREDS} q),
c AS (SELECT doc_id, label, count(*) AS n FROM p GROUP BY doc_id, label),
h AS (SELECT doc_id, arg_min(label, (-n, label)) AS hard_vote FROM c GROUP BY doc_id),
s AS (SELECT doc_id, avg(prob) AS mean_prob FROM p GROUP BY doc_id)
SELECT doc_id, hard_vote, round(mean_prob, 6) AS mean_prob, (mean_prob >= 0.5)::INTEGER AS soft_vote FROM h JOIN s USING (doc_id)
""")
def vote(spark, sf):
    p = _vote_preds(spark, sf).withColumn("label", (F.col("prob") >= 0.5).cast("int"))
    v = K.vote(p, "doc_id", "label", "prob")
    return v.select("doc_id", "hard_vote", rnd("mean_prob").alias("mean_prob"), "soft_vote")


def _study_sql():
    return f"""
WITH g AS (SELECT * FROM (VALUES (0.5, 1), (0.5, 2), (0.5, 3), (0.8, 1), (0.8, 2), (0.8, 3)) t(frac, seed)),
d AS (SELECT {_LI_KEY} AS rid, l_quantity AS x, l_extendedprice AS y FROM lineitem),
x AS (SELECT g.frac, g.seed, d.x, d.y,
             (('0x' || substr(md5(d.rid || ':' || g.seed::VARCHAR), 1, 8))::UBIGINT / 4294967296.0) < g.frac AS train
      FROM d, g),
f AS (SELECT frac, seed, regr_slope(y, x) AS m, regr_intercept(y, x) AS b FROM x WHERE train GROUP BY frac, seed),
e AS (SELECT x.frac, x.seed, sqrt(avg((y - m * x - b) ^ 2)) AS rmse FROM x JOIN f USING (frac, seed) WHERE NOT train
      GROUP BY x.frac, x.seed)
SELECT frac::DOUBLE AS frac, round(avg(rmse), 4) AS rmse_mean, round(stddev_pop(rmse), 4) AS rmse_std, count(*) AS n_splits
FROM e GROUP BY frac"""


@register("split_study", sql=_study_sql())
def split_study(spark, sf):
    li = Tables(spark, sf).lineitem.select(F.concat_ws(":", "l_orderkey", "l_linenumber").alias("rid"),
                                           "l_quantity", "l_extendedprice")
    s = K.split_study(li, "rid", "l_quantity", "l_extendedprice", [0.5, 0.8], [1, 2, 3])
    return s.select("frac", rnd("rmse_mean", 4).alias("rmse_mean"), rnd("rmse_std", 4).alias("rmse_std"), "n_splits")


@register("learning_curve", sql=f"""
WITH d AS (SELECT l_quantity AS x, l_extendedprice AS y, {_u(_LI_KEY, 8)} < 0.2 AS test,
                  {_u(_LI_KEY, '8:size')} AS v FROM lineitem),
s AS (SELECT * FROM (VALUES (0.1), (0.3), (1.0)) t(size)),
f AS (SELECT size, regr_slope(y, x) AS m, regr_intercept(y, x) AS b, count(*) AS n_train FROM d, s
      WHERE NOT test AND v < size GROUP BY size)
SELECT size::DOUBLE AS size, n_train, round(sqrt(avg((y - m * x - b) ^ 2)), 4) AS rmse FROM d, f WHERE test GROUP BY size, n_train
""")
def learning_curve(spark, sf):
    li = Tables(spark, sf).lineitem.select(F.concat_ws(":", "l_orderkey", "l_linenumber").alias("rid"),
                                           "l_quantity", "l_extendedprice")
    c = K.learning_curve(li, "rid", "l_quantity", "l_extendedprice", [0.1, 0.3, 1.0], 8)
    return c.select("size", "n_train", rnd("rmse", 4).alias("rmse"))


@register("kmeans_clusters")
def kmeans_clusters(spark, sf):
    """KMeans (k = 10) on the vectors: cluster sizes and agreement with labels."""
    em = Tables(spark, sf).embeddings
    m, d = K.kmeans(em, "embedding", 10, 1)
    return m.transform(d).groupBy("prediction").agg(F.count(F.lit(1)).alias("size"),
                                                    F.count_distinct("label").alias("n_labels"))


@register("pca_scores")
def pca_scores(spark, sf):
    """PCA (3 components) of centred vectors: per-row scores."""
    em = Tables(spark, sf).embeddings
    s, model = K.pca_scores(em, "embedding", 3, "vec_id")
    return s


@register("pu_learning")
def pu_learning(spark, sf):
    """PU scores: positives revealed with c = 0.6, SCAR estimate of c on a
    held-out positive set, p(y) = clip(p(s) / c, 0, 1)."""
    d = _doc_feats(spark, sf).withColumn("s", ((F.col("quality") == 1) & (md5_unit("doc_id", 17) < 0.6)).cast("double"))
    return K.pu_scores(d, _DOC_FEATS, "s", "doc_id")


@register("pick_prior", sql=f"""
WITH s AS {_SCORED_SQL},
p AS (SELECT (1 - greatest(0.01, least(0.99, avg(score)))) * (count(score) - 1) AS pos,
             list_sort(list(score) FILTER (WHERE score IS NOT NULL)) AS v FROM s),
t AS (SELECT CASE WHEN floor(pos) = ceil(pos) THEN v[floor(pos)::BIGINT + 1]
                  ELSE (ceil(pos) - pos) * v[floor(pos)::BIGINT + 1] + (pos - floor(pos)) * v[ceil(pos)::BIGINT + 1] END AS thr
      FROM p)
SELECT doc_id, score FROM s, t WHERE score >= thr
""")
def pick_prior(spark, sf):
    return K.pick_prior(scored_docs(spark, sf).select("doc_id", "score"), "score")


@register("linear_probe")
def linear_probe(spark, sf):
    """Linear probe on frozen vectors: multinomial logistic regression,
    accuracy on a hash test split."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector
    em = Tables(spark, sf).embeddings.withColumn("features", array_to_vector("embedding")) \
        .withColumn("y", F.col("label").cast("double")).withColumn("train", md5_unit("vec_id", 2) < 0.8)
    m = LogisticRegression(featuresCol="features", labelCol="y", family="multinomial", maxIter=100).fit(em.where("train"))
    p = m.transform(em.where(~F.col("train")))
    return p.agg(F.avg((F.col("prediction") == F.col("y")).cast("double")).alias("accuracy"),
                 F.count(F.lit(1)).alias("n_test"))


@register("score_batch")
def score_batch(spark, sf):
    """All documents scored by a model read back from the shared folder, with
    audit columns (features used, ok flag, error)."""
    d = _doc_feats(spark, sf).withColumn("toxic", F.col("toxic").cast("double"))
    path = scratch_path(spark, "model")
    K.save_model(K.logreg(d.where("train"), _DOC_FEATS, "toxic"), _DOC_FEATS, path)
    docs = Tables(spark, sf).documents.select("doc_id", *FE.text_features("text"))
    return K.score_saved(path, docs, ["doc_id"]).select("doc_id", "prediction", "p1", "features_used", "ok", "error")


@register("multinomial_bins")
def multinomial_bins(spark, sf):
    """Price in three exact quantile classes from quantity, discount and tax: test
    rows by class and predicted class."""
    feats = ["l_quantity", "l_discount", "l_tax"]
    d = K.binned_target(_li_split(spark, sf), "l_extendedprice", 3)
    m = K.multinomial(d.where("train"), feats, "label")
    p = m.transform(K.assemble(d.where(~F.col("train")), feats))
    return p.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@register("mlp_grid")
def mlp_grid(spark, sf):
    """Validation accuracy of three layer layouts on standardised text features."""
    d = _doc_feats(spark, sf).withColumn("quality", F.col("quality").cast("double"))
    z = FE.apply_scaler(d, FE.fit_scaler(d.where("train"), _DOC_FEATS), _DOC_FEATS)
    return K.mlp_grid(z.where("train"), z.where(~F.col("train")), _DOC_FEATS, "quality", [[4], [8], [8, 4]], seed=3)



@register("gbt_regressor")
def gbt_regressor(spark, sf):
    """Gradient-boosted trees on line features; test RMSE."""
    d = _li_split(spark, sf)
    feats = ["l_quantity", "l_discount", "l_tax"]
    m = K.gbt_regressor(d.where("train"), feats, "l_extendedprice", iters=20, depth=3, seed=1)
    p = m.transform(K.assemble(d.where(~F.col("train")), feats))
    return p.agg(F.sqrt(F.avg((F.col("prediction") - F.col("l_extendedprice")) ** 2)).alias("test_rmse"),
                 F.count(F.lit(1)).alias("n_test"))


@register("mlp_classifier")
def mlp_classifier(spark, sf):
    """MLP (one hidden layer of 8) on standardised text features; accuracy."""
    d = _doc_feats(spark, sf).withColumn("quality", F.col("quality").cast("double"))
    sc = FE.fit_scaler(d.where("train"), _DOC_FEATS)
    z = FE.apply_scaler(d, sc, _DOC_FEATS)
    m = K.mlp_classifier(z.where("train"), _DOC_FEATS, "quality", [8], seed=3)
    p = m.transform(K.assemble(z.where(~F.col("train")), _DOC_FEATS))
    return p.agg(F.avg((F.col("prediction") == F.col("quality")).cast("double")).alias("accuracy"),
                 F.count(F.lit(1)).alias("n_test"))


@register("bisecting_clusters")
def bisecting_clusters(spark, sf):
    """Top-down hierarchical clustering (bisecting k-means) for k = 2..6:
    within-cluster cost per k."""
    em = Tables(spark, sf).embeddings
    rows = []
    for k in range(2, 7):
        m, d = K.bisecting(em, "embedding", k, 1)
        rows.append((k, float(m.summary.trainingCost)))
    return spark.createDataFrame(rows, "k int, cost double")


@register("cv_table")
def cv_table(spark, sf):
    """5-fold cross-validated RMSE of ridge over an alpha grid (folds from
    hash ranks)."""
    o = Tables(spark, sf).orders.select("o_orderkey", F.col("o_custkey").cast("double").alias("c"),
                                        F.dayofyear("o_orderdate").cast("double").alias("doy"), "o_totalprice")
    f = FE.kfold(o, "o_orderkey", 5, 11)
    return K.cv_table(f, ["c", "doy"], "o_totalprice", "fold", [0.1, 10.0])


@register("permutation_importance")
def permutation_importance(spark, sf):
    """Accuracy drop of the forest when each feature is permuted (2 repeats)."""
    d = _doc_feats(spark, sf).withColumn("quality", F.col("quality").cast("double"))
    m = K.tree(d.where("train"), _DOC_FEATS, "quality", 5, 1, forest=10, seed=7)
    return K.permutation_importance(m, d.where(~F.col("train")).select("doc_id", *_DOC_FEATS, "quality"),
                                    _DOC_FEATS, "quality", "doc_id", 2, 5)


@register("self_training")
def self_training(spark, sf):
    """Self-training with pseudo-labels at p >= 0.70 / p <= 0.30: documents
    without labels are the unlabelled pool; reports pseudo-label count and
    test accuracy of the refit."""
    t = Tables(spark, sf)
    feats_all = _text_feats(t)
    lab = feats_all.join(t.labels, "doc_id").withColumn("toxic", F.col("toxic").cast("double"))
    lab = written(lab.withColumn("train", md5_unit("doc_id", 5) < 0.75), "doc-features")
    unl = written(feats_all.join(t.labels.select("doc_id"), "doc_id", "left_anti"), "doc-features-rest")
    m, n_pseudo = K.self_train(lab.where("train"), unl, _DOC_FEATS, "toxic")
    p = m.transform(K.assemble(lab.where(~F.col("train")), _DOC_FEATS))
    return p.agg(F.avg((F.col("prediction") == F.col("toxic")).cast("double")).alias("accuracy"),
                 F.lit(n_pseudo).alias("n_pseudo"))


@register("oob_score")
def oob_score(spark, sf):
    """Out-of-bag accuracy of 8 Poisson-bagged depth-4 trees on text features."""
    d = _doc_feats(spark, sf).withColumn("quality", F.col("quality").cast("double"))
    return K.oob_score(d.select("doc_id", *_DOC_FEATS, "quality"), _DOC_FEATS, "quality", "doc_id", 8, 4, 21)


# ---------------------------------------------------------------- more fits
@register("linreg_two_features", sql=f"""
WITH d AS (SELECT l_quantity AS a, l_discount AS b, l_extendedprice AS y FROM lineitem WHERE {_u(_LI_KEY, 42)} < 0.8),
s AS (SELECT covar_pop(a, a) AS aa, covar_pop(b, b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS b_y,
             avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM d),
c AS (SELECT *, (ay * bb - b_y * ab) / (aa * bb - ab * ab) AS p, (b_y * aa - ay * ab) / (aa * bb - ab * ab) AS q FROM s)
SELECT f.feature, round(f.coef, 3) AS coef FROM c, LATERAL (
  SELECT unnest(['l_quantity', 'l_discount', 'intercept']) AS feature, unnest([p, q, my - p * ma - q * mb]) AS coef) f
""")
def linreg_two_features(spark, sf):
    feats = ["l_quantity", "l_discount"]
    m = K.linreg(_li_split(spark, sf).where("train"), feats, "l_extendedprice", "ols")
    return K.coefficients(m, feats).select("feature", F.round("coef", 3).alias("coef"))


def _order_frame(spark, sf):
    return Tables(spark, sf).lineitem.select(
        F.concat_ws(":", "l_orderkey", "l_linenumber").alias("rid"), "l_quantity", "l_discount", "l_tax", "l_extendedprice",
        (md5_unit(F.concat_ws(":", "l_orderkey", "l_linenumber"), 42) < 0.8).alias("train"))


@register("cluster_centres")
def cluster_centres(spark, sf):
    """KMeans (k = 4) of standardised columns; centres in own units, sizes."""
    return K.cluster_in_units(_order_frame(spark, sf), "rid", ["l_quantity", "l_discount", "l_extendedprice"], 4, 3)[1]


@register("pca_loadings")
def pca_loadings(spark, sf):
    """Loadings of two components fitted on the training rows, with shares."""
    d = _order_frame(spark, sf)
    _, loadings, shares = K.pca_tables(d.where("train"), d.where("not train"),
                                       ["l_quantity", "l_discount", "l_tax", "l_extendedprice"], 2, "rid")
    return loadings.join(shares, "component")


@register("tree_regressors")
def tree_regressors(spark, sf):
    """Regression trees of three depths and a forest: leaves, root rule, error."""
    d, feats = _order_frame(spark, sf), ["l_quantity", "l_discount", "l_tax"]
    one = K.tree_report(d.where("train"), d.where("not train"), feats, "l_extendedprice", [1, 3, 5])
    many = K.tree_report(d.where("train"), d.where("not train"), feats, "l_extendedprice", [4], trees=5, seed=2)
    return one.withColumn("trees", F.lit(1)).unionByName(many.withColumn("trees", F.lit(5)))


@register("cv_best")
def cv_best(spark, sf):
    """Best ridge alpha of a 5-fold grid and the refit on all rows."""
    o = Tables(spark, sf).orders.select("o_orderkey", F.col("o_custkey").cast("double").alias("c"),
                                        F.dayofyear("o_orderdate").cast("double").alias("doy"), "o_totalprice")
    return K.cv_best(FE.kfold(o, "o_orderkey", 5, 11), ["c", "doy"], "o_totalprice", "fold", [0.1, 10.0, 1000.0])


@register("best_threshold", sql=f"""
WITH y AS (SELECT score, y AS quality FROM {_SCORED_SQL} s WHERE score IS NOT NULL),
t AS (SELECT DISTINCT score AS t FROM y),
f AS (SELECT t, 2.0 * count(*) FILTER (quality = 1 AND score >= t) /
                (count(*) FILTER (score >= t) + count(*) FILTER (quality = 1)) AS f1 FROM t, y GROUP BY t)
SELECT round(t, 6) AS threshold, round(f1, 6) AS f1 FROM f ORDER BY f1 DESC, t DESC LIMIT 1
""")
def best_threshold(spark, sf):
    return K.best_threshold(scored_docs(spark, sf), "y", "score").select(F.round("threshold", 6).alias("threshold"), F.round("f1", 6).alias("f1"))
