"""Section L: similarity, retrieval and graph jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from vialflow.functions.stats import rnd
from vialflow.functions.vectors import centroids
from vialflow.operators import graph as G
from vialflow.operators import similarity as L
from vialflow.operators.mining import chunk
from vialflow.plans.columns import _u
from vialflow.plans.registry import register
from vialflow.session import small, written
from vialflow.sources.tables import Tables

_CENT_SQL = """(SELECT label, list(m ORDER BY pos) AS c FROM (
    SELECT label, pos, avg(x) AS m FROM (
      SELECT label, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings)
    GROUP BY label, pos) GROUP BY label)"""


def _cos(a, b):
    dot = f"list_sum(list_transform(list_zip({a}, {b}), lambda p: p[1] * p[2]))"
    na = f"sqrt(list_sum(list_transform({a}, lambda x: x * x)))"
    nb = f"sqrt(list_sum(list_transform({b}, lambda x: x * x)))"
    return f"(CASE WHEN {na} = 0 OR {nb} = 0 THEN 0.0 ELSE {dot} / ({na} * {nb}) END)"


def _euc(a, b):
    return f"sqrt(list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))"


_EMB_SQL = "(SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)"


def _cents(spark, sf):
    em = Tables(spark, sf).embeddings
    return centroids(em, "label", "embedding").withColumnRenamed("label", "query")


@register("knn_prototypes", sql=f"""
WITH c AS {_CENT_SQL}, e AS {_EMB_SQL},
s AS (SELECT c.label AS query, e.vec_id, {_cos('e.v', 'c.c')} AS score FROM e, c)
SELECT query, vec_id, round(score, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
""")
def knn_prototypes(spark, sf):
    em = Tables(spark, sf).embeddings
    k = L.knn(em, _cents(spark, sf), "vec_id", "query", "embedding", "centroid", 5, "cosine")
    return k.select("query", "vec_id", rnd("score").alias("score"), F.col("rank").cast("bigint").alias("rank"))


@register("knn_overlap", sql=f"""
WITH c AS {_CENT_SQL}, e AS {_EMB_SQL},
s AS (SELECT c.label AS query, e.vec_id, {_cos('e.v', 'c.c')} AS cs, {_euc('e.v', 'c.c')} AS eu FROM e, c),
a AS (SELECT query, vec_id FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY cs DESC, vec_id) AS r FROM s) WHERE r <= 10),
b AS (SELECT query, vec_id FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY eu, vec_id) AS r FROM s) WHERE r <= 10)
SELECT c.label AS query, count(b.vec_id)::BIGINT AS overlap
FROM c LEFT JOIN (a JOIN b USING (query, vec_id)) ON a.query = c.label GROUP BY c.label
""")
def knn_overlap(spark, sf):
    em = Tables(spark, sf).embeddings
    return L.knn_overlap(em, _cents(spark, sf), "vec_id", "query", "embedding", "centroid", 10)


_PROTO_SQL = f"""(SELECT label, template, list(m ORDER BY pos) AS proto FROM (
    SELECT label, template, pos, avg(x) AS m FROM (
      SELECT label, floor({_u('vec_id', 3)} * 2)::INTEGER AS template, generate_subscripts(embedding, 1) AS pos,
             unnest(embedding)::DOUBLE AS x FROM embeddings)
    GROUP BY label, template, pos) GROUP BY label, template)"""


@register("prototype_classify", sql=f"""
WITH p AS {_PROTO_SQL}, e AS {_EMB_SQL},
s AS (SELECT e.vec_id, p.label AS cls, avg({_cos('e.v', 'p.proto')}) AS sim FROM e, p GROUP BY e.vec_id, p.label),
z AS (SELECT *, exp(sim / 0.1 - max(sim / 0.1) OVER (PARTITION BY vec_id)) AS ez FROM s),
q AS (SELECT *, ez / sum(ez) OVER (PARTITION BY vec_id) AS prob,
             row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, cls) AS r FROM z)
SELECT vec_id, cls AS pred, round(sim, 6) AS sim, round(prob, 6) AS prob FROM q WHERE r = 1
""")
def prototype_classify(spark, sf):
    em = Tables(spark, sf).embeddings
    protos = L.template_prototypes(em, "label", "embedding", 2, 3)
    p = L.prototype_classify(em, protos, "vec_id", "embedding", "label", 0.1)
    return p.select("vec_id", "pred", rnd("sim").alias("sim"), rnd("prob").alias("prob"))


@register("cross_retrieve", sql=f"""
WITH p AS {_PROTO_SQL}, e AS {_EMB_SQL},
s AS (SELECT e.vec_id, p.label || ':' || p.template::VARCHAR AS proto_id, {_cos('e.v', 'p.proto')} AS score FROM e, p),
a AS (SELECT 'item_to_proto' AS direction, vec_id, proto_id, score,
             row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, proto_id) AS rank FROM s),
b AS (SELECT 'proto_to_item' AS direction, vec_id, proto_id, score,
             row_number() OVER (PARTITION BY proto_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT direction, vec_id, proto_id, round(score, 6) AS score, rank FROM a WHERE rank <= 3
UNION ALL SELECT direction, vec_id, proto_id, round(score, 6), rank FROM b WHERE rank <= 3
""")
def cross_retrieve(spark, sf):
    em = Tables(spark, sf).embeddings
    protos = L.template_prototypes(em, "label", "embedding", 2, 3).select(
        F.concat_ws(":", F.col("label").cast("string"), F.col("template").cast("string")).alias("proto_id"), "proto")
    # items -> prototypes: each item ranks the (few) prototypes
    a = L.knn(protos.withColumnRenamed("proto", "pv"), em.select("vec_id", "embedding"), "proto_id", "vec_id",
              "pv", "embedding", 3, "cosine", few="items").select(F.lit("item_to_proto").alias("direction"), "vec_id", "proto_id",
                                                     "score", "rank")
    b = L.knn(em, protos, "vec_id", "proto_id", "embedding", "proto", 3, "cosine").select(
        F.lit("proto_to_item").alias("direction"), "vec_id", "proto_id", "score", "rank")
    return a.unionByName(b).select("direction", "vec_id", "proto_id", rnd("score").alias("score"),
                                   F.col("rank").cast("bigint").alias("rank"))


@register("tanimoto_pairs", sql=r"""
WITH d AS (SELECT doc_id, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> ''))) AS s
           FROM documents),
r AS (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY s) AS rep FROM d WHERE len(s) > 0),
tok AS (SELECT doc_id, len(s) AS n, unnest(s) AS tok FROM r WHERE doc_id = rep),
i AS (SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS shared
      FROM tok x JOIN tok y ON x.tok = y.tok AND x.doc_id < y.doc_id AND y.n >= 0.8 * x.n AND x.n >= 0.8 * y.n GROUP BY 1, 2)
SELECT a, b, round(shared / (na + nb - shared), 9) AS jaccard FROM i WHERE shared / (na + nb - shared) >= 0.8
UNION ALL SELECT rep, doc_id, 1.0 FROM r WHERE doc_id <> rep
""")
def tanimoto_pairs(spark, sf):
    """Documents' word sets: pairs of different sets with Jaccard >= 0.8, by
    the smallest document of each, and copies linked to that document."""
    d = Tables(spark, sf).documents.select("doc_id", L.tokenize_words("text").alias("tokens"))
    return L.tanimoto_pairs(d, "doc_id", "tokens", 0.8).select("a", "b", F.round("jaccard", 9).alias("jaccard"))


def _chunks(spark, sf):
    return chunk(Tables(spark, sf).documents, "doc_id", "text", 50, 10)


_CHUNK_SQL = r"""(WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 10 - 1, 0) + 1, 40)) AS st FROM w),
c AS (SELECT doc_id, w, st, (row_number() OVER (PARTITION BY doc_id ORDER BY st) - 1)::INTEGER AS chunk_no FROM s)
SELECT doc_id, chunk_no, array_to_string(w[st + 1 : st + 50], ' ') AS text FROM c WHERE st < len(w) OR (len(w) = 0 AND st = 0))"""

_TOK = r"list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"

_RETRIEVE_SQL = f"""(WITH ch AS {_CHUNK_SQL},
ct AS (SELECT doc_id, chunk_no, unnest({_TOK.format('text')}) AS term FROM ch),
tf AS (SELECT doc_id, chunk_no, term, count(*) AS c FROM ct GROUP BY ALL),
n AS (SELECT count(*) AS n FROM ch),
idf AS (SELECT term, ln((1 + n) / (1 + count(*))) + 1 AS idf FROM tf, n GROUP BY term, n),
cw AS (SELECT doc_id, chunk_no, term, c * idf AS w FROM tf JOIN idf USING (term)),
cv AS (SELECT doc_id, chunk_no, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id, chunk_no)) AS weight FROM cw),
qt AS (SELECT item_id, unnest({_TOK.format('text')}) AS term FROM benchmark),
qw AS (SELECT item_id, term, count(*) * idf AS w FROM qt JOIN idf USING (term) GROUP BY item_id, term, idf),
qv AS (SELECT item_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS qweight FROM qw),
s AS (SELECT item_id, doc_id, chunk_no, round(sum(qweight * weight), 9) AS score FROM qv JOIN cv USING (term)
      GROUP BY item_id, doc_id, chunk_no)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, chunk_no) AS rank FROM s)
WHERE rank <= 3)"""


def _hits(spark, sf):
    return L.retrieve(Tables(spark, sf).benchmark, "item_id", "text", _chunks(spark, sf), ["doc_id", "chunk_no"], "text", 3)


@register("retrieve", sql=f"SELECT item_id, doc_id, chunk_no, round(score, 6) AS score, rank FROM {_RETRIEVE_SQL}")
def retrieve(spark, sf):
    h = _hits(spark, sf)
    return h.select("item_id", "doc_id", "chunk_no", rnd("score").alias("score"), F.col("rank").cast("bigint").alias("rank"))


@register("build_context", sql=f"""
WITH h AS {_RETRIEVE_SQL}, ch AS {_CHUNK_SQL},
j AS (SELECT h.item_id, h.rank, h.doc_id::VARCHAR || '#' || h.chunk_no::VARCHAR AS src, ch.text
      FROM h JOIN ch USING (doc_id, chunk_no))
SELECT item_id, list(src ORDER BY rank) AS sources,
       md5('Context:' || chr(10) || string_agg('[' || src || '] ' || text, chr(10) ORDER BY rank) || chr(10) || chr(10) ||
           'Answer using only the context.') AS digest
FROM j GROUP BY item_id
""")
def build_context(spark, sf):
    hits = written(_hits(spark, sf), "hits")
    # only documents that hold a hit are cut into chunks again
    docs = Tables(spark, sf).documents.join(small(hits.select("doc_id").distinct()), "doc_id", "left_semi")
    c = L.build_context(hits, "item_id", chunk(docs, "doc_id", "text", 50, 10), ["doc_id", "chunk_no"], "text")
    return c.select("item_id", "sources", F.md5("prompt").alias("digest"))


@register("make_pairs", sql=f"""
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {_u('o_orderkey', 13)}, o_orderkey) - 1 AS idx,
                  count(*) OVER () AS n FROM orders)
SELECT o_orderkey AS anchor, o_orderkey AS other, 1 AS positive FROM orders
UNION ALL
SELECT a.o_orderkey, b.o_orderkey, 0 FROM r a JOIN r b ON b.idx = (a.idx + 1) % a.n
""")
def make_pairs(spark, sf):
    from vialflow.functions.hashing import md5_unit
    o = Tables(spark, sf).orders.select("o_orderkey")
    return L.make_pairs(o, "o_orderkey", md5_unit("o_orderkey", 13))


# ------------------------------------------------------------------ graph
SUPPLIER_OFFSET = 1_000_000_000


def _edges(spark, sf):
    li = Tables(spark, sf).lineitem
    return li.select(F.col("l_partkey").alias("src"), (F.col("l_suppkey") + SUPPLIER_OFFSET).alias("dst"),
                     F.col("l_quantity").alias("w"))


def _nodes(spark, sf):
    t = Tables(spark, sf)
    return (t.part.select(F.col("p_partkey").alias("node_id"), F.lit("part").alias("kind"),
                          (F.col("p_retailprice") / 1000.0).alias("x"))
            .unionByName(t.supplier.select((F.col("s_suppkey") + SUPPLIER_OFFSET).alias("node_id"),
                                           F.lit("supplier").alias("kind"), (F.col("s_acctbal") / 1000.0).alias("x"))))


_EDGES_SQL = f"(SELECT l_partkey AS src, l_suppkey + {SUPPLIER_OFFSET} AS dst, l_quantity AS w FROM lineitem)"
_NODES_SQL = (f"(SELECT p_partkey AS node_id, 'part' AS kind, p_retailprice / 1000.0 AS x FROM part UNION ALL "
              f"SELECT s_suppkey + {SUPPLIER_OFFSET}, 'supplier', s_acctbal / 1000.0 FROM supplier)")


@register("expand_edges", sql=f"""
WITH e AS {_EDGES_SQL}, d AS (SELECT DISTINCT src, dst FROM (SELECT src, dst FROM e UNION ALL SELECT dst, src FROM e))
SELECT src AS node_id, count(*) AS degree FROM d GROUP BY src
""")
def expand_edges(spark, sf):
    return G.degree(G.expand_edges(_edges(spark, sf)))


_BOTH_SQL = f"(SELECT src, dst, w FROM {_EDGES_SQL} UNION ALL SELECT dst, src, w FROM {_EDGES_SQL})"


def _both(spark, sf):
    e = _edges(spark, sf)
    return e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))


@register("aggregate_neighbours", sql=f"""
SELECT e.dst AS node_id, round(avg(n.x * e.w), 6) AS agg
FROM {_BOTH_SQL} e JOIN {_NODES_SQL} n ON n.node_id = e.src GROUP BY e.dst
""")
def aggregate_neighbours(spark, sf):
    a = G.aggregate_neighbours(_nodes(spark, sf), _both(spark, sf), "mean", weight="w")
    return a.select("node_id", rnd("agg").alias("agg"))


def _mp_step_sql(prev):
    return f"""(SELECT n.node_id, tanh(0.5 * n.x + 0.5 * coalesce(a.agg, 0.0)) AS x
  FROM {prev} n LEFT JOIN (SELECT e.dst AS node_id, avg(p.x) AS agg FROM {_BOTH_SQL} e JOIN {prev} p ON p.node_id = e.src
                           GROUP BY e.dst) a USING (node_id))"""


@register("message_pass", sql=f"""
WITH s0 AS (SELECT node_id, x FROM {_NODES_SQL}), s1 AS {_mp_step_sql('s0')}, s2 AS {_mp_step_sql('s1')},
s3 AS {_mp_step_sql('s2')}
SELECT node_id, round(x, 6) AS x FROM s3
""")
def message_pass(spark, sf):
    m = G.message_pass(_nodes(spark, sf), _both(spark, sf).drop("w"), 3, 0.5, 0.5, checkpoint_every=2)
    return m.select("node_id", rnd("x").alias("x"))


# vectors of three features per node: price or balance, size or nation, kind
_VEC_SQL = (f"(SELECT p_partkey AS node_id, 'part' AS kind, p_retailprice / 1000.0 AS x0, p_size / 25.0 AS x1, 1.0 AS x2 FROM part "
            f"UNION ALL SELECT s_suppkey + {SUPPLIER_OFFSET}, 'supplier', s_acctbal / 5000.0, s_nationkey / 12.0, -1.0 FROM supplier)")


def _vectors(spark, sf):
    t = Tables(spark, sf)
    return (t.part.select(F.col("p_partkey").alias("node_id"), F.lit("part").alias("kind"), F.array(
                F.col("p_retailprice") / 1000.0, F.col("p_size") / 25.0, F.lit(1.0)).alias("x"))
            .unionByName(t.supplier.select((F.col("s_suppkey") + SUPPLIER_OFFSET).alias("node_id"), F.lit("supplier").alias("kind"), F.array(
                F.col("s_acctbal") / 5000.0, F.col("s_nationkey") / 12.0, F.lit(-1.0)).alias("x"))))


def _vec_step_sql(prev):
    z = ", ".join(f"tanh(0.6 * n.x{k} + 0.8 * coalesce(a.x{k}, 0.0)) AS z{k}" for k in range(3))
    return f"""(SELECT node_id, z0 * s AS x0, z1 * s AS x1, z2 * s AS x2 FROM (
  SELECT *, least(1.0, 1.2 / greatest(sqrt(z0 * z0 + z1 * z1 + z2 * z2), 1e-8)) AS s FROM (
    SELECT n.node_id, {z} FROM {prev} n LEFT JOIN (
      SELECT e.dst AS node_id, avg(p.x0) AS x0, avg(p.x1) AS x1, avg(p.x2) AS x2
      FROM {_BOTH_SQL} e JOIN {prev} p ON p.node_id = e.src GROUP BY e.dst) a USING (node_id))))"""


@register("message_pass_vectors", sql=f"""
WITH s0 AS (SELECT * FROM {_VEC_SQL}), s1 AS {_vec_step_sql('s0')}, s2 AS {_vec_step_sql('s1')}
SELECT node_id, round(x0, 6) AS x0, round(x1, 6) AS x1, round(x2, 6) AS x2 FROM s2
""")
def message_pass_vectors(spark, sf):
    """Two vector steps; vectors longer than 1.2 are scaled back to that norm."""
    m = G.message_pass(_vectors(spark, sf), _both(spark, sf).drop("w"), 2, 0.6, 0.8, cap=1.2)
    return m.select("node_id", *[rnd(F.col("x")[k]).alias(f"x{k}") for k in range(3)])


# weights of the typed step: 2 outputs from 3 inputs; an embedding per return flag
_W_SELF, _W_NEI = ((0.5, -0.2, 0.1), (-0.3, 0.4, 0.2)), ((0.02, 0.01, -0.03), (0.01, -0.02, 0.02))
_TYPES = (("A", (0.1, 0.0, -0.1)), ("N", (0.0, 0.2, 0.0)), ("R", (-0.1, 0.1, 0.3)))


def _typed_sql():
    dot = lambda w, c: " + ".join(f"{v} * coalesce({c}{k}, 0.0)" for k, v in enumerate(w))
    types = ", ".join(f"('{t}', {e[0]}, {e[1]}, {e[2]})" for t, e in _TYPES)
    out = ", ".join(f"round(greatest(0.0, {dot(s, 'n.x')} + {dot(w, 'a.m')}), 6) AS h{i}" for i, (s, w) in enumerate(zip(_W_SELF, _W_NEI)))
    return f"""
WITH v AS {_VEC_SQL}, t(type, e0, e1, e2) AS (VALUES {types}),
e AS (SELECT l_partkey AS src, l_suppkey + {SUPPLIER_OFFSET} AS dst, l_returnflag AS type FROM lineitem),
b AS (SELECT src, dst, type FROM e UNION ALL SELECT dst, src, type FROM e),
a AS (SELECT b.dst AS node_id, sum(v.x0 + t.e0) AS m0, sum(v.x1 + t.e1) AS m1, sum(v.x2 + t.e2) AS m2
      FROM b JOIN v ON v.node_id = b.src JOIN t USING (type) GROUP BY b.dst)
SELECT n.node_id, {out} FROM v n LEFT JOIN a USING (node_id)"""


@register("typed_message", sql=_typed_sql())
def typed_message(spark, sf):
    """Typed message step over part-supplier edges, the return flag as type."""
    li = Tables(spark, sf).lineitem
    e = li.select(F.col("l_partkey").alias("src"), (F.col("l_suppkey") + SUPPLIER_OFFSET).alias("dst"), F.col("l_returnflag").alias("type"))
    both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "type"))
    emb = spark.createDataFrame([(t, list(map(float, v))) for t, v in _TYPES], "type string, e array<double>")
    m = G.typed_message(_vectors(spark, sf), both, _W_SELF, _W_NEI, F.broadcast(emb))
    return m.select("node_id", *[rnd(F.col("x")[k]).alias(f"h{k}") for k in range(2)])


@register("pool_graph", sql=f"""
SELECT kind, round(avg(x), 6) AS pooled, count(*) AS n_nodes FROM {_NODES_SQL} GROUP BY kind
""")
def pool_graph(spark, sf):
    p = G.pool(_nodes(spark, sf), "kind", "mean")
    return p.select("kind", rnd("pooled").alias("pooled"), "n_nodes")


@register("pool_graph_vectors", sql=f"""
SELECT kind, round(sum(x0), 4) AS p0, round(sum(x1), 4) AS p1, round(sum(x2), 4) AS p2, count(*) AS n_nodes FROM {_VEC_SQL} GROUP BY kind
""")
def pool_graph_vectors(spark, sf):
    p = G.pool(_vectors(spark, sf), "kind", "sum")
    return p.select("kind", *[rnd(F.col("pooled")[k], 4).alias(f"p{k}") for k in range(3)], "n_nodes")


@register("shortest_path", sql=f"""
WITH RECURSIVE e AS MATERIALIZED {_BOTH_SQL},
s AS (SELECT min(l_suppkey) + {SUPPLIER_OFFSET} AS node_id FROM lineitem),
bfs(node_id, d) USING KEY (node_id) AS (
  SELECT node_id, 0 FROM s
  UNION
  SELECT e.dst, min(b.d) + 1 FROM bfs b JOIN e ON e.src = b.node_id
  WHERE NOT EXISTS (SELECT 1 FROM recurring.bfs r WHERE r.node_id = e.dst) GROUP BY e.dst)
SELECT node_id, d::INTEGER AS d FROM bfs
""")
def shortest_path(spark, sf):
    """Steps from the first supplier to every part and supplier over lineitem."""
    e = _edges(spark, sf).select("src", "dst")
    start = e.agg(F.min("dst")).first()[0]
    return G.distances(e, start).select("node_id", F.col("d").cast("int").alias("d"))


@register("pick_examples", sql=f"""
WITH p AS (SELECT d.doc_id, d.text, l.toxic FROM documents d JOIN labels l USING (doc_id) WHERE l.toxic IS NOT NULL),
tf AS (SELECT doc_id, term, count(*) AS c FROM (SELECT doc_id, unnest({_TOK.format('text')}) AS term FROM p) GROUP BY ALL),
n AS (SELECT count(*) AS n FROM p),
idf AS (SELECT term, ln((1 + n) / (1 + count(*))) + 1 AS idf FROM tf, n GROUP BY term, n),
pw AS (SELECT doc_id, term, c * idf AS w FROM tf JOIN idf USING (term)),
pv AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM pw),
qt AS (SELECT item_id, unnest({_TOK.format('text')}) AS term FROM benchmark),
qw AS (SELECT item_id, term, count(*) * idf AS w FROM qt JOIN idf USING (term) GROUP BY item_id, term, idf),
qv AS (SELECT item_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS qweight FROM qw),
s AS (SELECT item_id, doc_id, round(sum(qweight * weight), 9) AS score FROM qv JOIN pv USING (term) GROUP BY ALL),
a AS (SELECT b.item_id, p.doc_id, p.toxic, coalesce(s.score, 0.0) AS score
      FROM (SELECT DISTINCT item_id FROM benchmark) b CROSS JOIN p LEFT JOIN s ON s.item_id = b.item_id AND s.doc_id = p.doc_id),
c AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY item_id, toxic ORDER BY score DESC, doc_id) = 1 THEN 0 ELSE 1 END AS stage FROM a)
SELECT item_id, doc_id, toxic, score, pick FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY stage, score DESC, doc_id)::INTEGER AS pick FROM c) WHERE pick <= 4
""")
def pick_examples(spark, sf):
    """Four few-shot examples per benchmark question from the labelled
    documents, covering both toxicity classes first."""
    t = Tables(spark, sf)
    pool = t.documents.select("doc_id", "text").join(t.labels.select("doc_id", "toxic"), "doc_id")
    return L.pick_examples(t.benchmark, "item_id", "text", pool, "doc_id", "text", "toxic", 4)
