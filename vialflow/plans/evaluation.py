"""Sections I (splits, features) and J (evaluation)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vialflow.functions.stats import rnd
from vialflow.functions.vectors import centroids
from vialflow.operators import features as FE
from vialflow.operators import metrics as M
from vialflow.plans.columns import _u
from vialflow.plans.registry import register
from vialflow.sources.tables import Tables

# ------------------------------------------------------------------ I


@register("split", sql=f"""
SELECT o_orderkey, CASE WHEN {_u('o_orderkey', 42)} < 0.8 THEN 'train' ELSE 'test' END AS split FROM orders
""")
def split(spark, sf):
    return FE.split(Tables(spark, sf).orders.select("o_orderkey"), "o_orderkey", 0.8, 42)


@register("split_stratified", sql=f"""
WITH r AS (SELECT doc_id, toxic, {_u('doc_id', 7)} AS u,
                  row_number() OVER (PARTITION BY toxic ORDER BY {_u('doc_id', 7)}, doc_id) AS rk,
                  count(*) OVER (PARTITION BY toxic) AS n FROM labels)
SELECT doc_id, toxic, CASE WHEN n < 2 THEN CASE WHEN u < 0.75 THEN 'train' ELSE 'test' END
                           WHEN rk <= floor(n * 0.75 + 0.5) THEN 'train' ELSE 'test' END AS split FROM r
""")
def split_stratified(spark, sf):
    lb = Tables(spark, sf).labels.select("doc_id", "toxic")
    return FE.split_stratified(lb, "doc_id", "toxic", 0.75, 7)


@register("kfold", sql=f"""
SELECT doc_id, quality, ((row_number() OVER (PARTITION BY quality ORDER BY {_u('doc_id', 3)}, doc_id) - 1) % 5)::INTEGER AS fold
FROM labels
""")
def kfold(spark, sf):
    lb = Tables(spark, sf).labels.select("doc_id", "quality")
    return FE.kfold(lb, "doc_id", 5, 3, y="quality")


_ORD_SPLIT_SQL = f"""(SELECT o_orderkey, o_totalprice, o_custkey::DOUBLE AS o_custkey,
  CASE WHEN {_u('o_orderkey', 42)} < 0.8 THEN 'train' ELSE 'test' END AS split FROM orders)"""


def _orders_split(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice", F.col("o_custkey").cast("double"))
    return FE.split(o, "o_orderkey", 0.8, 42)


@register("standard_scaler", sql=f"""
WITH o AS {_ORD_SPLIT_SQL},
s AS (SELECT avg(o_totalprice) AS m1, stddev_pop(o_totalprice) AS s1, avg(o_custkey) AS m2, stddev_pop(o_custkey) AS s2
      FROM o WHERE split = 'train')
SELECT o_orderkey, round((o_totalprice - m1) / CASE WHEN s1 = 0 THEN 1 ELSE s1 END, 6) AS o_totalprice,
       round((o_custkey - m2) / CASE WHEN s2 = 0 THEN 1 ELSE s2 END, 6) AS o_custkey
FROM o, s WHERE split = 'test'
""")
def standard_scaler(spark, sf):
    o = _orders_split(spark, sf)
    cols = ["o_totalprice", "o_custkey"]
    sc = FE.fit_scaler(o.where(F.col("split") == "train"), cols)
    t = FE.apply_scaler(o.where(F.col("split") == "test").select("o_orderkey", *cols), sc, cols)
    return t.select("o_orderkey", *[rnd(c).alias(c) for c in cols])


@register("minmax_scaler", sql=f"""
WITH o AS {_ORD_SPLIT_SQL},
s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM o WHERE split = 'train')
SELECT o_orderkey, round(CASE WHEN hi = lo THEN 0 ELSE (o_totalprice - lo) / (hi - lo) END, 6) AS scaled,
       round((CASE WHEN hi = lo THEN 0 ELSE (o_totalprice - lo) / (hi - lo) END) * (hi - lo) + lo, 4) AS restored
FROM o, s
""")
def minmax_scaler(spark, sf):
    o = _orders_split(spark, sf)
    mm = FE.fit_minmax(o.where(F.col("split") == "train"), ["o_totalprice"])
    sc = FE.apply_minmax(o.select("o_orderkey", "o_totalprice"), mm, ["o_totalprice"])
    back = FE.apply_minmax(sc, mm, ["o_totalprice"], invert=True).withColumnRenamed("o_totalprice", "restored")
    return (sc.withColumnRenamed("o_totalprice", "scaled").join(back, "o_orderkey")
            .select("o_orderkey", rnd("scaled").alias("scaled"), rnd("restored", 4).alias("restored")))


@register("one_hot", sql=f"""
SELECT event_id, {", ".join(f"(event_type = '{v}')::INTEGER AS event_type_{v}" for v in ["click", "error", "purchase", "signup", "view"])}
FROM events
""")
def one_hot(spark, sf):
    ev = Tables(spark, sf).events.select("event_id", "event_type")
    train = FE.split(ev, "event_id", 0.8, 1).where(F.col("split") == "train")
    levels = FE.category_levels(train, "event_type")
    return FE.one_hot(ev, "event_type", levels).drop("event_type")


@register("text_features", sql="""
SELECT doc_id, length(text)::BIGINT AS n_chars,
       len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))::BIGINT AS n_words,
       len(string_split(text, chr(10)))::BIGINT AS n_lines,
       round(CASE WHEN length(text) = 0 THEN 0 ELSE (length(text) - length(regexp_replace(text, '[0-9]', '', 'g')))::DOUBLE / length(text) END, 6) AS digit_share,
       round(CASE WHEN length(text) = 0 THEN 0 ELSE (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')))::DOUBLE / length(text) END, 6) AS upper_share,
       round(CASE WHEN length(text) = 0 THEN 0 ELSE (length(text) - length(regexp_replace(text, '[.,;:!?]', '', 'g')))::DOUBLE / length(text) END, 6) AS punct_share,
       round(CASE WHEN len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) = 0 THEN 0
                  ELSE list_sum(list_transform(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''), lambda w: length(w)))::DOUBLE
                       / len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) END, 6) AS mean_word_len
FROM documents
""")
def text_features(spark, sf):
    d = Tables(spark, sf).documents
    return d.select("doc_id", *FE.text_features("text"))


@register("fingerprint", sql="""
WITH n AS (SELECT doc_id, regexp_replace(lower(text), '\\s+', ' ', 'g') AS t FROM documents),
g AS (SELECT doc_id, list_distinct(list_transform(
        list_filter(list_transform(range(1, greatest(length(t) - 2, 0) + 1), lambda i: substr(t, i, 3)), lambda s: length(s) = 3),
        lambda s: (('0x' || substr(md5(s), 1, 8))::UBIGINT % 1024)::INTEGER)) AS bits FROM n)
SELECT doc_id, len(bits)::INTEGER AS n_bits_set,
       list_transform(range(32), lambda w: coalesce(list_sum(list_transform(list_filter(bits, lambda b: b // 32 = w),
                                                                      lambda b: (1::BIGINT << (b % 32)))), 0)::BIGINT) AS words
FROM g
""")
def fingerprint(spark, sf):
    fp = FE.fingerprint(Tables(spark, sf).documents, "doc_id", "text", 1024, 3)
    return fp.select("doc_id", F.size("bits").alias("n_bits_set"), FE.pack_bits(F.col("bits"), 1024, 32).alias("words"))


@register("canonical_key", sql="""
WITH c AS (SELECT doc_id, md5(trim(regexp_replace(regexp_replace(lower(text), '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))) AS key,
                  md5(regexp_replace(regexp_replace(trim(regexp_replace(regexp_replace(lower(text), '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')),
                      '[0-9]+', '0', 'g'), '[^ 0.,;:!?]+', 'a', 'g')) AS skeleton FROM documents)
SELECT doc_id, key, skeleton, count(*) OVER (PARTITION BY key) AS n_copies FROM c
""")
def canonical_key(spark, sf):
    d = Tables(spark, sf).documents
    k = d.select("doc_id", F.md5(FE.canonical_text("text")).alias("key"), F.md5(FE.skeleton_text("text")).alias("skeleton"))
    copies = k.groupBy("key").agg(F.count(F.lit(1)).alias("n_copies"))
    return k.join(copies, "key").select("doc_id", "key", "skeleton", "n_copies")


@register("sample_n", sql=f"""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY {_u('o_orderkey', 9)}, o_orderkey LIMIT 25
""")
def sample_n(spark, sf):
    return FE.sample_n(Tables(spark, sf).orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 25, 9)


# ------------------------------------------------------------------ J
_PRED_SQL = """(SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice AS y,
  l_quantity * (SELECT sum(l_extendedprice) / sum(l_quantity) FROM lineitem) AS yhat FROM lineitem)"""


def _preds(spark, sf):
    li = Tables(spark, sf).lineitem
    unit = li.agg(F.sum("l_extendedprice") / F.sum("l_quantity")).scalar()
    return li.select("l_orderkey", "l_linenumber", "l_returnflag", F.col("l_extendedprice").alias("y"),
                     (F.col("l_quantity") * unit).alias("yhat"))


@register("regression_metrics", sql=f"""
SELECT l_returnflag, count(*) AS n, round(avg((y - yhat) ^ 2), 1) AS mse, round(sqrt(avg((y - yhat) ^ 2)), 4) AS rmse,
       round(avg(abs(y - yhat)), 4) AS mae,
       round(CASE WHEN var_pop(y) * count(y) = 0 THEN NULL ELSE 1 - sum((y - yhat) ^ 2) / (var_pop(y) * count(y)) END, 6) AS r2
FROM {_PRED_SQL} p GROUP BY l_returnflag
""")
def regression_metrics(spark, sf):
    m = M.regression_metrics(_preds(spark, sf), "y", "yhat", by=["l_returnflag"], digits=12)
    return m.select("l_returnflag", "n", rnd("mse", 1).alias("mse"), rnd("rmse", 4).alias("rmse"),
                    rnd("mae", 4).alias("mae"), rnd("r2", 6).alias("r2"))


@register("residuals", sql=f"""
SELECT l_orderkey, l_linenumber, round(y - yhat, 4) AS residual,
       round((SELECT least(min(y), min(yhat)) FROM {_PRED_SQL} q), 4) AS parity_lo,
       round((SELECT greatest(max(y), max(yhat)) FROM {_PRED_SQL} q), 4) AS parity_hi
FROM {_PRED_SQL} p
""")
def residuals(spark, sf):
    r = M.residuals(_preds(spark, sf), "y", "yhat")
    return r.select("l_orderkey", "l_linenumber", *[rnd(c, 4).alias(c) for c in ("residual", "parity_lo", "parity_hi")])


# Scored documents: y = toxic label, score = share of junk characters.
_SCORED_SQL = """(SELECT d.doc_id, l.toxic AS y, l.quality,
  (length(d.text) - length(regexp_replace(d.text, '[0-9#%*&|@]', '', 'g')))::DOUBLE / length(d.text) AS score
  FROM documents d JOIN labels l USING (doc_id))"""


def scored_docs(spark, sf):
    t = Tables(spark, sf)
    d = t.documents.select("doc_id", ((F.length("text") - F.length(F.regexp_replace("text", "[0-9#%*&|@]", "")))
                                      .cast("double") / F.length("text")).alias("score"))
    return d.join(t.labels.select("doc_id", F.col("toxic").alias("y"), "quality"), "doc_id")


def _bin_sql(t):
    return f"""sum(CASE WHEN y = 1 AND score >= {t} THEN 1 ELSE 0 END)::BIGINT AS tp,
       sum(CASE WHEN y = 0 AND score >= {t} THEN 1 ELSE 0 END)::BIGINT AS fp,
       sum(CASE WHEN y = 1 AND score < {t} THEN 1 ELSE 0 END)::BIGINT AS fn,
       sum(CASE WHEN y = 0 AND score < {t} THEN 1 ELSE 0 END)::BIGINT AS tn"""


_METRICS_FROM_COUNTS = """round(CASE WHEN tp + fp + fn + tn = 0 THEN 0 ELSE (tp + tn)::DOUBLE / (tp + fp + fn + tn) END, 6) AS accuracy,
       round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp::DOUBLE / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp::DOUBLE / (tp + fn) END, 6) AS recall,
       round(CASE WHEN tp = 0 THEN 0 ELSE 2.0 * (tp::DOUBLE / (tp + fp)) * (tp::DOUBLE / (tp + fn))
             / ((tp::DOUBLE / (tp + fp)) + (tp::DOUBLE / (tp + fn))) END, 6) AS f1"""


@register("binary_metrics", sql=f"""
SELECT tp, fp, fn, tn, {_METRICS_FROM_COUNTS} FROM (SELECT {_bin_sql(0.01)} FROM {_SCORED_SQL} s)
""")
def binary_metrics(spark, sf):
    return M.binary_metrics(scored_docs(spark, sf), "y", "score", 0.01)


_SWEEP = [0.0, 0.005, 0.01, 0.02, 0.05, 0.1]


@register("threshold_sweep", sql="\nUNION ALL\n".join(
    f"SELECT {t}::DOUBLE AS threshold, tp, fp, fn, tn, {_METRICS_FROM_COUNTS} FROM (SELECT {_bin_sql(t)} FROM {_SCORED_SQL} s)"
    for t in _SWEEP))
def threshold_sweep(spark, sf):
    return M.threshold_sweep(scored_docs(spark, sf), "y", "score", _SWEEP)


_EV_PRED_SQL = """(SELECT event_id, event_type AS true_type,
  CASE WHEN value < 10 THEN 'view' WHEN value < 30 THEN 'click' WHEN value < 60 THEN 'signup'
       WHEN value < 120 THEN 'error' ELSE 'purchase' END AS pred_type FROM events)"""


def _ev_preds(spark, sf):
    ev = Tables(spark, sf).events
    v = F.col("value")
    pred = (F.when(v < 10, "view").when(v < 30, "click").when(v < 60, "signup").when(v < 120, "error")
            .otherwise("purchase"))
    return ev.select("event_id", F.col("event_type").alias("true_type"), pred.alias("pred_type"))


@register("confusion", sql=f"""
WITH p AS {_EV_PRED_SQL},
c AS (SELECT DISTINCT x AS c FROM (SELECT true_type AS x FROM p UNION ALL SELECT pred_type FROM p) WHERE x IS NOT NULL),
g AS (SELECT a.c AS "true", b.c AS pred FROM c a, c b),
n AS (SELECT true_type AS "true", pred_type AS pred, count(*) AS cnt FROM p GROUP BY 1, 2),
j AS (SELECT g."true", g.pred, coalesce(n.cnt, 0)::BIGINT AS count FROM g LEFT JOIN n ON g."true" = n."true" AND g.pred = n.pred)
SELECT "true", pred, count,
       round(CASE WHEN sum(count) OVER (PARTITION BY "true") = 0 THEN 0
                  ELSE count::DOUBLE / sum(count) OVER (PARTITION BY "true") END, 6) AS row_share FROM j
""")
def confusion(spark, sf):
    return M.confusion(_ev_preds(spark, sf), "true_type", "pred_type")


@register("class_report", sql=f"""
WITH p AS {_EV_PRED_SQL},
c AS (SELECT DISTINCT x AS cls FROM (SELECT true_type AS x FROM p UNION ALL SELECT pred_type FROM p) WHERE x IS NOT NULL),
s AS (SELECT c.cls,
             (SELECT count(*) FROM p WHERE true_type = c.cls AND pred_type = c.cls) AS tp,
             (SELECT count(*) FROM p WHERE true_type = c.cls) AS support,
             (SELECT count(*) FROM p WHERE pred_type = c.cls) AS npred FROM c),
m AS (SELECT cls, CASE WHEN npred = 0 THEN 0 ELSE tp::DOUBLE / npred END AS pr,
             CASE WHEN support = 0 THEN 0 ELSE tp::DOUBLE / support END AS rc, support FROM s),
f AS (SELECT cls, pr, rc, CASE WHEN pr + rc = 0 THEN 0 ELSE 2 * pr * rc / (pr + rc) END AS f1, support FROM m)
SELECT cls, round(pr, 6) AS precision, round(rc, 6) AS recall, round(f1, 6) AS f1, support::BIGINT AS support FROM f
UNION ALL
SELECT 'macro avg', round(avg(pr), 6), round(avg(rc), 6), round(avg(f1), 6), sum(support)::BIGINT FROM f
""")
def class_report(spark, sf):
    return M.class_report(_ev_preds(spark, sf), "true_type", "pred_type")


_SCORE_COUNTS_SQL = f"""(SELECT score AS s, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos,
  sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS neg FROM {_SCORED_SQL} x WHERE score IS NOT NULL GROUP BY score)"""


@register("roc_curve", sql=f"""
WITH c AS {_SCORE_COUNTS_SQL},
t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM c)
SELECT s AS threshold,
       round(CASE WHEN P = 0 THEN 0 ELSE sum(pos) OVER w / P END, 6) AS tpr,
       round(CASE WHEN N = 0 THEN 0 ELSE sum(neg) OVER w / N END, 6) AS fpr
FROM c, t WINDOW w AS (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def roc_curve(spark, sf):
    return M.roc(scored_docs(spark, sf), "y", "score")


@register("roc_auc", sql=f"""
WITH c AS {_SCORE_COUNTS_SQL},
r AS (SELECT s, pos, neg, sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS neg_le FROM c)
SELECT round(CASE WHEN sum(pos) * sum(neg) = 0 THEN 0 ELSE sum(pos * (neg_le - neg + neg / 2.0)) / (sum(pos) * sum(neg)) END, 6) AS auc,
       sum(pos)::BIGINT AS n_pos, sum(neg)::BIGINT AS n_neg FROM r
""")
def roc_auc(spark, sf):
    return M.auc(scored_docs(spark, sf), "y", "score")


@register("pr_curve", sql=f"""
WITH c AS {_SCORE_COUNTS_SQL},
t AS (SELECT sum(pos) AS P FROM c),
r AS (SELECT s, pos, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM c
      WINDOW w AS (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT s AS threshold, round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN P = 0 THEN 0 ELSE tp / P END, 6) AS recall, pos::BIGINT AS pos FROM r, t
""")
def pr_curve(spark, sf):
    return M.pr_curve(scored_docs(spark, sf), "y", "score")


@register("average_precision", sql=f"""
WITH c AS {_SCORE_COUNTS_SQL},
t AS (SELECT sum(pos) AS P FROM c),
r AS (SELECT s, pos, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM c
      WINDOW w AS (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT round(sum(CASE WHEN P = 0 THEN 0 ELSE pos / P END * CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END), 6)
       AS average_precision FROM r, t
""")
def average_precision(spark, sf):
    return M.average_precision(scored_docs(spark, sf), "y", "score")


_CENTROID_SQL = """(SELECT label, list(m ORDER BY pos) AS centroid FROM (
    SELECT label, pos, avg(x) AS m FROM (
      SELECT label, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings)
    GROUP BY label, pos) GROUP BY label)"""


@register("inertia", sql=f"""
WITH c AS {_CENTROID_SQL},
d AS (SELECT e.label, list_sum(list_transform(list_zip(list_transform(embedding, lambda x: x::DOUBLE), centroid),
                                              lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d2
      FROM embeddings e JOIN c USING (label)),
per AS (SELECT label, sum(d2) AS s, count(*) AS n FROM d GROUP BY label)
SELECT label, round(s, 6) AS inertia, n::BIGINT AS n FROM per
UNION ALL SELECT NULL, round(sum(s), 6), sum(n)::BIGINT FROM per
""")
def inertia(spark, sf):
    em = Tables(spark, sf).embeddings
    return M.inertia(em, "embedding", "label", centroids(em, "label", "embedding"))


@register("silhouette_sq", sql="""
WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
p AS (SELECT a.vec_id, a.label, b.label AS other, b.vec_id AS j,
             list_sum(list_transform(list_zip(a.v, b.v), lambda q: (q[1] - q[2]) * (q[1] - q[2]))) AS d2
      FROM e a, e b),
m AS (SELECT vec_id, label, other, sum(d2) AS s, count(*) AS n FROM p GROUP BY vec_id, label, other),
ab AS (SELECT vec_id, label,
              max(CASE WHEN other = label AND n > 1 THEN s / (n - 1) END) AS a,
              min(CASE WHEN other <> label THEN s / n END) AS b FROM m GROUP BY vec_id, label)
SELECT vec_id, label, round(CASE WHEN a IS NULL OR b IS NULL THEN 0.0 WHEN greatest(a, b) = 0 THEN 0.0
                                 ELSE (b - a) / greatest(a, b) END, 6) AS silhouette FROM ab
""")
def silhouette_sq(spark, sf):
    em = Tables(spark, sf).embeddings
    return M.silhouette_sq(em, "vec_id", "embedding", "label")


@register("cluster_agreement", sql="""
WITH e AS (SELECT label AS a, (embedding[1] > 0)::INTEGER * 2 + (embedding[2] > 0)::INTEGER AS b FROM embeddings),
nab AS (SELECT a, b, count(*)::DOUBLE AS nij FROM e GROUP BY a, b),
na AS (SELECT a, count(*)::DOUBLE AS ai FROM e GROUP BY a),
nb AS (SELECT b, count(*)::DOUBLE AS bj FROM e GROUP BY b),
k AS (SELECT (SELECT count(*)::DOUBLE FROM e) AS N,
             (SELECT sum(nij * (nij - 1) / 2) FROM nab) AS sij,
             (SELECT sum(ai * (ai - 1) / 2) FROM na) AS sa,
             (SELECT sum(bj * (bj - 1) / 2) FROM nb) AS sb,
             (SELECT -sum(ai / (SELECT count(*) FROM e) * ln(ai / (SELECT count(*) FROM e))) FROM na) AS ha,
             (SELECT -sum(bj / (SELECT count(*) FROM e) * ln(bj / (SELECT count(*) FROM e))) FROM nb) AS hb,
             (SELECT sum(nij / (SELECT count(*) FROM e) * ln((SELECT count(*) FROM e) * nij / (ai * bj)))
              FROM nab JOIN na USING (a) JOIN nb USING (b)) AS mi)
SELECT round(CASE WHEN (sa + sb) / 2 - sa * sb / (N * (N - 1) / 2) = 0 THEN 1.0
                  ELSE (sij - sa * sb / (N * (N - 1) / 2)) / ((sa + sb) / 2 - sa * sb / (N * (N - 1) / 2)) END, 6) AS ari,
       round(CASE WHEN ha + hb = 0 THEN 1.0 ELSE mi / ((ha + hb) / 2) END, 6) AS nmi FROM k
""")
def cluster_agreement(spark, sf):
    em = Tables(spark, sf).embeddings
    b = (F.col("embedding")[0] > 0).cast("int") * 2 + (F.col("embedding")[1] > 0).cast("int")
    return M.cluster_agreement(em.select(F.col("label").alias("a"), b.alias("b")), "a", "b")


@register("class_balance", sql="""
SELECT toxic, count(*) AS n, round(count(*) / (SELECT count(*) FROM labels), 6) AS share FROM labels GROUP BY toxic
""")
def class_balance(spark, sf):
    return M.class_balance(Tables(spark, sf).labels, "toxic")


@register("prediction_sample", sql=f"""
SELECT doc_id, y, (score >= 0.01)::INTEGER AS yhat, y = (score >= 0.01)::INTEGER AS correct
FROM {_SCORED_SQL} s ORDER BY {_u('doc_id', 42)}, doc_id LIMIT 20
""")
def prediction_sample(spark, sf):
    s = scored_docs(spark, sf).withColumn("yhat", (F.col("score") >= 0.01).cast("int"))
    return M.prediction_sample(s, "doc_id", "y", "yhat", 20, 42)

