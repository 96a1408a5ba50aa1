"""Section H: scalar, string, array, JSON and vector functions in table jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from vialflow.functions import scalar as S
from vialflow.functions import text as T
from vialflow.functions import vectors as V
from vialflow.functions.hashing import hash_noise, md5_unit
from vialflow.functions.stats import rnd, rnd_half_up, sigmoid
from vialflow.plans.registry import register
from vialflow.plans.standins import CONDS, RUNS_SQL, runs
from vialflow.sources.tables import Tables


def _u(key_sql: str, seed) -> str:
    """DuckDB twin of ``md5_unit``."""
    return f"(('0x' || substr(md5(concat(({key_sql})::VARCHAR, ':', '{seed}')), 1, 8))::UBIGINT / 4294967296.0)"


def _normal_sql(key_sql: str, seed) -> str:
    h = f"md5(concat(({key_sql})::VARCHAR, ':', '{seed}'))"
    u1 = f"(('0x' || substr({h}, 1, 8))::UBIGINT / 4294967296.0)"
    u2 = f"(('0x' || substr({h}, 9, 8))::UBIGINT / 4294967296.0)"
    return f"(sqrt(-2.0 * ln(1.0 - {u1})) * cos(2.0 * pi() * {u2}))"


# ------------------------------------------------------------- formulas
# Formula stand-in: built from part attributes; a hash picks a few with an
# element outside the weight table and a few with parentheses.
def _formulas(spark, sf):
    pa = Tables(spark, sf).part
    u = md5_unit("p_partkey", "el")
    tail = F.when(u < 0.10, F.lit("Xe")).when(u < 0.15, F.lit("(OH)2")).otherwise(F.lit("O2"))
    f = F.concat(F.lit("C"), F.col("p_size").cast("string"), F.lit("H"),
                 (F.col("p_size") * 2 + 2).cast("string"), tail)
    return pa.select("p_partkey", "p_brand", "p_retailprice", f.alias("formula"))


_FORMULA_SQL = f"""(SELECT p_partkey, p_brand, p_retailprice,
  'C' || p_size::VARCHAR || 'H' || (p_size * 2 + 2)::VARCHAR ||
  CASE WHEN {_u('p_partkey', 'el')} < 0.10 THEN 'Xe' WHEN {_u('p_partkey', 'el')} < 0.15 THEN '(OH)2' ELSE 'O2' END
  AS formula FROM part)"""

_WEIGHTS_SQL = "(VALUES " + ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in S.ATOMIC_WEIGHTS.items()) + ") w(e, aw)"

_MASS_SQL = f"""(SELECT f.p_partkey, f.p_brand, f.p_retailprice, f.formula,
  CASE WHEN regexp_replace(f.formula, '([A-Z][a-z]?)([0-9]*)', '', 'g') <> '' OR length(f.formula) = 0 THEN NULL
       WHEN bool_or(w.aw IS NULL) THEN NULL ELSE sum(w.aw * t.n) END AS molar_mass,
  CASE WHEN regexp_replace(f.formula, '([A-Z][a-z]?)([0-9]*)', '', 'g') <> '' OR length(f.formula) = 0 THEN 'unparsed'
       WHEN bool_or(w.aw IS NULL) THEN 'unknown element: ' || string_agg(DISTINCT CASE WHEN w.aw IS NULL THEN t.e END, ', ')
  END AS error
FROM {_FORMULA_SQL} f
LEFT JOIN (SELECT p_partkey, unnest(regexp_extract_all(formula, '([A-Z][a-z]?)([0-9]*)', 1)) AS e,
                  CASE WHEN unnest(regexp_extract_all(formula, '([A-Z][a-z]?)([0-9]*)', 2)) = '' THEN 1
                       ELSE unnest(regexp_extract_all(formula, '([A-Z][a-z]?)([0-9]*)', 2))::INTEGER END AS n
           FROM {_FORMULA_SQL}) t ON t.p_partkey = f.p_partkey
LEFT JOIN {_WEIGHTS_SQL} ON w.e = t.e
GROUP BY f.p_partkey, f.p_brand, f.p_retailprice, f.formula)"""


@register("molar_mass", sql=f"""
SELECT p_partkey, formula, round(molar_mass, 6) AS molar_mass, error FROM {_MASS_SQL}
""")
def molar_mass(spark, sf):
    f = _formulas(spark, sf)
    return f.select("p_partkey", "formula", rnd(S.molar_mass("formula")).alias("molar_mass"),
                    S.formula_error("formula").alias("error"))


@register("largest_moles", sql=f"""
WITH m AS (SELECT p_brand, p_partkey, (p_retailprice / 100.0) / molar_mass AS moles FROM {_MASS_SQL}
           WHERE molar_mass IS NOT NULL)
SELECT p_brand, arg_max(p_partkey, (moles, -p_partkey)) AS p_partkey, round(max(moles), 6) AS moles
FROM m GROUP BY p_brand
""")
def largest_moles(spark, sf):
    f = _formulas(spark, sf).withColumn("_mm", S.molar_mass("formula"))
    m = f.where(F.col("_mm").isNotNull()).select(
        "p_brand", "p_partkey", S.grams_to_moles(F.col("p_retailprice") / 100.0, "_mm").alias("moles"))
    return m.groupBy("p_brand").agg(
        F.max_by("p_partkey", F.struct("moles", -F.col("p_partkey"))).alias("p_partkey"),
        rnd(F.max("moles")).alias("moles"))


@register("convert_units", sql="""
SELECT l_orderkey, l_linenumber, round(l_tax * 1000 + 273.15, 6) AS temp_k,
       round(l_quantity / 18.015, 6) AS moles, round((l_extendedprice / 1000.0) * 0.997 + 1e-9, 6) AS grams
FROM lineitem
""")
def convert_units(spark, sf):
    li = Tables(spark, sf).lineitem
    return li.select("l_orderkey", "l_linenumber",
                     rnd(S.celsius_to_kelvin(F.col("l_tax") * 1000)).alias("temp_k"),
                     rnd(S.grams_to_moles("l_quantity", F.lit(18.015))).alias("moles"),
                     rnd_half_up(S.ml_to_grams(F.col("l_extendedprice") / 1000.0, F.lit(0.997))).alias("grams"))


@register("parse_quantity", sql="""
WITH t AS (SELECT p_partkey, (p_size * 10)::VARCHAR ||
                  CASE WHEN p_size > 25 THEN 'K' WHEN p_size > 5 THEN 'C' ELSE 'F' END AS txt FROM part)
SELECT p_partkey, txt, regexp_extract(txt, '^([0-9]+)', 1)::BIGINT AS value,
       upper(regexp_extract(txt, '^[0-9]*(.*)$', 1)) AS unit,
       CASE upper(regexp_extract(txt, '^[0-9]*(.*)$', 1))
            WHEN 'C' THEN regexp_extract(txt, '^([0-9]+)', 1)::DOUBLE + 273.15
            WHEN 'K' THEN regexp_extract(txt, '^([0-9]+)', 1)::DOUBLE END AS kelvin
FROM t
""")
def parse_quantity(spark, sf):
    pa = Tables(spark, sf).part
    txt = F.concat((F.col("p_size") * 10).cast("string"),
                   F.when(F.col("p_size") > 25, "K").when(F.col("p_size") > 5, "C").otherwise("F"))
    return (pa.select("p_partkey", txt.alias("txt"))
            .select("p_partkey", "txt", S.parse_quantity("txt").alias("q"))
            .select("p_partkey", "txt", "q.value", "q.unit", "q.kelvin"))


@register("classify_reading", sql="""
SELECT event_id, CASE WHEN value / 35.0 < 7 THEN 'acidic' WHEN value / 35.0 > 7 THEN 'basic'
                      WHEN value / 35.0 = 7 THEN 'neutral' END AS status FROM events
""")
def classify_reading(spark, sf):
    ev = Tables(spark, sf).events
    return ev.select("event_id", S.classify_reading(F.col("value") / 35.0).alias("status"))


@register("log_offset", sql="""
SELECT l_orderkey, l_linenumber, round(log10(l_discount + 0.001), 6) AS log_discount FROM lineitem
""")
def log_offset(spark, sf):
    li = Tables(spark, sf).lineitem
    return li.select("l_orderkey", "l_linenumber", rnd(S.log_offset("l_discount", 1e-3)).alias("log_discount"))


@register("clip_values", sql="""
SELECT l_orderkey, l_linenumber, greatest(5.0, least(45.0, l_quantity)) AS clipped FROM lineitem
""")
def clip_values(spark, sf):
    li = Tables(spark, sf).lineitem
    return li.select("l_orderkey", "l_linenumber", S.clip("l_quantity", 5.0, 45.0).alias("clipped"))


@register("sigmoid_score", sql="""
SELECT l_orderkey, l_linenumber, round(1.0 / (1.0 + exp(-((l_quantity - 25) / 5.0))), 6) AS score,
       (1.0 / (1.0 + exp(-((l_quantity - 25) / 5.0))) >= 0.5)::INTEGER AS label FROM lineitem
""")
def sigmoid_score(spark, sf):
    li = Tables(spark, sf).lineitem
    x = (F.col("l_quantity") - 25) / 5.0
    return li.select("l_orderkey", "l_linenumber", rnd(sigmoid(x)).alias("score"),
                     S.sigmoid_label(x).alias("label"))


@register("gaussian_response", sql=f"""
SELECT r.l_orderkey, r.l_linenumber,
       round(0.1 + 0.6 * exp(-((r.yield * 50 - (10 + s.s_nationkey)) ^ 2) / (2 * 8.0 * 8.0))
                 + 0.4 * exp(-((r.l_discount - 0.05) ^ 2) / (2 * 0.03 * 0.03)), 6) AS expected
FROM {RUNS_SQL} r JOIN supplier s ON s.s_suppkey = r.l_suppkey
""")
def gaussian_response(spark, sf):
    su = Tables(spark, sf).supplier.select(F.col("s_suppkey").alias("l_suppkey"),
                                           (F.col("s_nationkey") + 10).cast("double").alias("mu_q"))
    r = runs(spark, sf).join(su, "l_suppkey")
    e = S.gaussian_response([(F.col("yield") * 50, F.col("mu_q"), 8.0, 0.6),
                             ("l_discount", 0.05, 0.03, 0.4)], base=0.1)
    return r.select("l_orderkey", "l_linenumber", rnd(e).alias("expected"))


_KEY = "concat(l_orderkey::VARCHAR, ':', l_linenumber::VARCHAR)"


@register("hash_noise", sql=f"""
SELECT l_orderkey, l_linenumber, round(({_u(_KEY, 11)} * 2.0 - 1.0) * 0.5, 6) AS u_noise,
       round({_normal_sql(_KEY, 12)} * 2.0, 6) AS n_noise FROM lineitem
""")
def hash_noise_q(spark, sf):
    li = Tables(spark, sf).lineitem
    key = F.concat_ws(":", "l_orderkey", "l_linenumber")
    return li.select("l_orderkey", "l_linenumber", rnd(hash_noise(key, 0.5, 11, "uniform")).alias("u_noise"),
                     rnd(hash_noise(key, 2.0, 12, "normal")).alias("n_noise"))


@register("hash_choice", sql=f"""
WITH c AS (SELECT p_partkey, CASE WHEN {_u('p_partkey', 7)} < 0.2 THEN 'low'
                                  WHEN {_u('p_partkey', 7)} < 0.7 THEN 'mid'
                                  WHEN {_u('p_partkey', 7)} < 1.0 THEN 'high' ELSE 'high' END AS level FROM part)
SELECT p_partkey, level,
       greatest(0, least(2, CASE WHEN {_u('p_partkey', 8)} < 0.1 THEN idx + 1
                                 WHEN {_u('p_partkey', 8)} < 0.2 THEN idx - 1 ELSE idx END)) AS stepped
FROM (SELECT *, CASE level WHEN 'low' THEN 0 WHEN 'mid' THEN 1 ELSE 2 END AS idx FROM c)
""")
def hash_choice(spark, sf):
    pa = Tables(spark, sf).part
    lv = S.hash_choice("p_partkey", ["low", "mid", "high"], [0.2, 0.5, 0.3], 7)
    d = pa.select("p_partkey", lv.alias("level"))
    idx = F.when(F.col("level") == "low", 0).when(F.col("level") == "mid", 1).otherwise(2)
    return d.select("p_partkey", "level", S.hash_step(idx, 3, 0.1, 0.1, "p_partkey", 8).alias("stepped"))


@register("label_from_name", sql="""
WITH h AS (SELECT page_id, lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) AS f FROM pages)
SELECT page_id, CASE WHEN starts_with(f, 'com_') THEN 1
                     WHEN starts_with(f, 'net_') OR starts_with(f, 'org_') THEN 0
                     WHEN contains(f, 'net') OR contains(f, 'org') THEN 0
                     WHEN contains(f, 'com') THEN 1 END AS label FROM h
""")
def label_from_name(spark, sf):
    pg = Tables(spark, sf).pages
    host = F.regexp_extract("url", r"^https?://([^/?#]+)", 1)
    return pg.select("page_id", T.label_from_name(host, "com", ["net", "org"]).alias("label"))


@register("char_vocab", sql="""
SELECT ch AS "char", (row_number() OVER (ORDER BY ch) + 1)::INTEGER AS id
FROM (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM documents) WHERE ch <> ''
""")
def char_vocab(spark, sf):
    return T.char_vocab(Tables(spark, sf).documents, "text")


@register("tokenize", sql="""
WITH v AS (SELECT ch, (row_number() OVER (ORDER BY ch) + 1)::INTEGER AS id
           FROM (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM documents) WHERE ch <> ''),
c AS (SELECT item_id, generate_subscripts(string_split(text, ''), 1) AS pos, unnest(string_split(text, '')) AS ch
      FROM benchmark),
t AS (SELECT item_id, list(coalesce(v.id, 1) ORDER BY pos) AS ids FROM c LEFT JOIN v USING (ch)
      WHERE c.ch <> '' GROUP BY item_id)
SELECT b.item_id, list_concat(coalesce(t.ids[1:64], []),
       list_transform(range(greatest(0, 64 - len(coalesce(t.ids[1:64], [])))), lambda x: 0)) AS ids
FROM benchmark b LEFT JOIN t USING (item_id)
""")
def tokenize(spark, sf):
    t = Tables(spark, sf)
    vocab = T.char_vocab(t.documents, "text")
    return T.tokenize(t.benchmark.select("item_id", "text"), "text", vocab, 64).select("item_id", "ids")


@register("positional_encoding", sql="""
WITH p AS (SELECT DISTINCT unnest(range(0, len(string_split(text, ' ')))) AS pos FROM benchmark),
d AS (SELECT range::INTEGER AS dim FROM range(16))
SELECT pos, dim, round(CASE WHEN dim % 2 = 0 THEN sin(pos / pow(10000.0, (floor(dim / 2) * 2) / 16.0))
                            ELSE cos(pos / pow(10000.0, (floor(dim / 2) * 2) / 16.0)) END, 6) AS value
FROM p, d
""")
def positional_encoding(spark, sf):
    bm = Tables(spark, sf).benchmark
    pos = bm.select(F.explode(F.sequence(F.lit(0), F.size(F.split("text", " ")) - 1)).alias("pos"))
    pe = T.positional_encoding(pos, "pos", 16)
    return pe.select(F.col("pos").cast("bigint").alias("pos"), "dim", rnd("value").alias("value"))


_REPLY_SQL = """(SELECT event_id, CASE WHEN event_type = 'error' THEN 'try ' || value::VARCHAR || ' next'
  ELSE props END AS reply FROM events)"""


@register("parse_suggestion", sql=f"""
SELECT event_id, coalesce(TRY_CAST(json_extract(CASE WHEN json_valid(reply) THEN reply END, '$.k') AS DOUBLE),
       TRY_CAST(nullif(regexp_extract(reply, '(-?[0-9]+(\\.[0-9]+)?)', 1), '') AS DOUBLE)) AS suggestion
FROM {_REPLY_SQL}
""")
def parse_suggestion(spark, sf):
    ev = Tables(spark, sf).events
    reply = F.when(F.col("event_type") == "error",
                   F.concat(F.lit("try "), F.col("value").cast("string"), F.lit(" next"))).otherwise(F.col("props"))
    return ev.select("event_id", T.parse_suggestion(reply).alias("suggestion"))


@register("strip_fences", sql="""
WITH f AS (SELECT conv_id, turn, text, CASE WHEN role = 'assistant' THEN '```json' || chr(10) || text || chr(10) || '```'
                                          ELSE text END AS reply FROM conversations)
SELECT conv_id, turn, md5(regexp_replace(regexp_replace(reply, '^\\s*```[A-Za-z0-9_-]*[ \\t]*\\r?\\n?', ''),
                                          '\\r?\\n?```\\s*$', '')) AS digest,
       regexp_replace(regexp_replace(reply, '^\\s*```[A-Za-z0-9_-]*[ \\t]*\\r?\\n?', ''), '\\r?\\n?```\\s*$', '') = text AS restored
FROM f
""")
def strip_fences(spark, sf):
    cv = Tables(spark, sf).conversations
    reply = F.when(F.col("role") == "assistant",
                   F.concat(F.lit("```json\n"), F.col("text"), F.lit("\n```"))).otherwise(F.col("text"))
    s = T.strip_fences(reply)
    return cv.select("conv_id", "turn", F.md5(s).alias("digest"), (s == F.col("text")).alias("restored"))


def _replies(spark, sf):
    cv = Tables(spark, sf).conversations
    u = md5_unit(F.concat_ws(":", "conv_id", "turn"), "lab")
    head = F.when(u < 0.4, "Yes").when(u < 0.7, "N").when(u < 0.85, "Note: unclear").otherwise("")
    rat = F.when(u < 0.9, F.concat(F.lit("Rationale: "), F.col("text"))).otherwise(F.col("text"))
    return cv.select("conv_id", "turn", F.concat(head, F.lit("\n"), rat).alias("reply"))


_REPLIES_SQL = f"""(SELECT conv_id, turn,
  CASE WHEN {_u("concat(conv_id::VARCHAR, ':', turn::VARCHAR)", 'lab')} < 0.4 THEN 'Yes'
       WHEN {_u("concat(conv_id::VARCHAR, ':', turn::VARCHAR)", 'lab')} < 0.7 THEN 'N'
       WHEN {_u("concat(conv_id::VARCHAR, ':', turn::VARCHAR)", 'lab')} < 0.85 THEN 'Note: unclear' ELSE '' END
  || chr(10) ||
  CASE WHEN {_u("concat(conv_id::VARCHAR, ':', turn::VARCHAR)", 'lab')} < 0.9 THEN 'Rationale: ' || text ELSE text END
  AS reply FROM conversations)"""


@register("parse_label", sql=f"""
WITH l AS (SELECT conv_id, turn,
                  list_filter(list_transform(regexp_split_to_array(reply, '\\r?\\n'), lambda s: trim(s, ' ')), lambda s: s <> '') AS lines
           FROM {_REPLIES_SQL}),
x AS (SELECT conv_id, turn, lines,
             list_filter(lines, lambda s: upper(regexp_extract(s, '^([A-Za-z]+)', 1)) IN ('Y', 'N', 'YES', 'NO')) AS lab,
             list_filter(lines, lambda s: starts_with(lower(s), 'rational')) AS rat FROM l)
SELECT conv_id, turn,
       coalesce(CASE WHEN len(lab) > 0 THEN substr(upper(regexp_extract(lab[1], '^([A-Za-z]+)', 1)), 1, 1) END, '') AS label,
       md5(coalesce(nullif(CASE WHEN len(rat) > 0 THEN trim(regexp_extract(rat[1], '^[^:]*:(.*)$', 1), ' ') END, ''),
                    CASE WHEN len(lines) >= 2 THEN lines[2] END, '')) AS rationale_digest
FROM x
""")
def parse_label(spark, sf):
    r = _replies(spark, sf)
    p = r.select("conv_id", "turn", T.parse_label("reply").alias("p"))
    return p.select("conv_id", "turn", "p.label", F.md5("p.rationale").alias("rationale_digest"))


@register("markdown_table", sql="""
WITH t AS (SELECT p_partkey, '| name | brand | size |' || chr(10) || '|---|:---:|---|' || chr(10) ||
                  '| ' || p_name || ' | ' || p_brand || ' | ' || p_size::VARCHAR || ' |' || chr(10) ||
                  '| ragged ' || p_partkey || ' | row |' || chr(10) ||
                  '| ' || p_type || ' | | ' || p_retailprice::VARCHAR || ' |' AS md FROM part),
l AS (SELECT p_partkey, list_filter(list_transform(regexp_split_to_array(md, '\\r?\\n'), lambda s: trim(s, ' ')),
                                    lambda s: s <> '' AND NOT regexp_full_match(s, '[\\s|:\\-]+') AND contains(s, '|')) AS lines
      FROM t),
c AS (SELECT p_partkey, list_transform(lines, lambda s: list_transform(
          string_split_regex(regexp_replace(regexp_replace(s, '^\\s*\\|', ''), '\\|\\s*$', ''), '\\|'), lambda x: trim(x, ' '))) AS cells
      FROM l),
r AS (SELECT p_partkey, cells[1] AS hdr, unnest(cells[2:]) AS vals, generate_subscripts(cells[2:], 1) AS row_no
      FROM c WHERE len(cells) >= 2 AND len(cells[1]) >= 2)
SELECT p_partkey, row_no::INTEGER AS row_no, hdr[i] AS "column", vals[i] AS value
FROM r, range(1, 1 + len(hdr)) t(i) WHERE len(vals) = len(hdr)
""")
def markdown_table(spark, sf):
    pa = Tables(spark, sf).part
    md = F.concat(F.lit("| name | brand | size |\n|---|:---:|---|\n| "), F.col("p_name"), F.lit(" | "),
                  F.col("p_brand"), F.lit(" | "), F.col("p_size").cast("string"), F.lit(" |\n| ragged "),
                  F.col("p_partkey").cast("string"), F.lit(" | row |\n| "), F.col("p_type"), F.lit(" | | "), F.col("p_retailprice").cast("string"), F.lit(" |"))
    return T.markdown_table(pa.select("p_partkey", md.alias("md")), "p_partkey", "md")


_JSONARR_SQL = """(SELECT event_id, CASE WHEN event_type = 'error' THEN '[' || props
  ELSE '[' || props || ', {"k": ' || user_id::VARCHAR || '}]' END AS js FROM events)"""


@register("json_rows", sql=f"""
WITH j AS (SELECT event_id, CASE WHEN json_valid(js) AND json_type(js) = 'ARRAY' THEN js END AS js FROM {_JSONARR_SQL}),
e AS (SELECT event_id, unnest(range(json_array_length(js)::BIGINT)) AS pos, js FROM j WHERE js IS NOT NULL)
SELECT event_id, pos::INTEGER AS pos, TRY_CAST(json_extract(js, '$[' || pos || '].k') AS INTEGER) AS k FROM e
""")
def json_rows(spark, sf):
    ev = Tables(spark, sf).events
    js = F.when(F.col("event_type") == "error", F.concat(F.lit("["), F.col("props"))).otherwise(
        F.concat(F.lit("["), F.col("props"), F.lit(', {"k": '), F.col("user_id").cast("string"), F.lit("}]")))
    return T.json_rows(ev.select("event_id", js.alias("js")), "event_id", "js", "k int")


_SCHEMA_SQL = """(SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'not json'
  WHEN event_type = 'error' THEN replace(props, '"k"', '"j"') ELSE props END AS js FROM events)"""


@register("enforce_schema", sql=f"""
WITH p0 AS (SELECT event_id, coalesce(starts_with(trim(js, ' '), '{{') AND suffix(trim(js, ' '), '}}'), false) AS is_obj,
                   CASE WHEN json_valid(js) THEN js END AS js FROM {_SCHEMA_SQL}),
p AS (SELECT event_id, is_obj AND js IS NOT NULL AS is_obj, js FROM p0)
SELECT event_id, CASE WHEN is_obj THEN TRY_CAST(json_extract(js, '$.k') AS DOUBLE) END AS k,
       is_obj AND TRY_CAST(json_extract(js, '$.k') AS DOUBLE) IS NOT NULL AS ok,
       CASE WHEN NOT is_obj THEN 'not a JSON object'
            WHEN TRY_CAST(json_extract(js, '$.k') AS DOUBLE) IS NULL THEN 'missing: k' END AS error
FROM p
""")
def enforce_schema(spark, sf):
    ev = Tables(spark, sf).events
    js = (F.when(F.col("event_type") == "purchase", F.lit("not json"))
          .when(F.col("event_type") == "error", F.replace("props", F.lit('"k"'), F.lit('"j"')))
          .otherwise(F.col("props")))
    return T.enforce_schema(ev.select("event_id", js.alias("js")), "js", "k double", ["k"]).drop("js")


_FLAGS_SQL = """(SELECT event_id, '{"fig": "' || CASE WHEN value > 100 THEN 'Y' ELSE 'n' END ||
  '", "table": "' || CASE WHEN event_type = 'click' THEN ' y ' ELSE 'maybe' END || '"}' AS js FROM events)"""


@register("flags_with_default", sql=f"""
SELECT event_id,
  CASE WHEN upper(trim(json_extract_string(js, '$.fig'), ' ')) IN ('Y', 'N') THEN upper(trim(json_extract_string(js, '$.fig'), ' ')) ELSE 'N' END AS fig,
  CASE WHEN upper(trim(json_extract_string(js, '$.table'), ' ')) IN ('Y', 'N') THEN upper(trim(json_extract_string(js, '$.table'), ' ')) ELSE 'N' END AS "table",
  CASE WHEN upper(trim(json_extract_string(js, '$.scheme'), ' ')) IN ('Y', 'N') THEN upper(trim(json_extract_string(js, '$.scheme'), ' ')) ELSE 'N' END AS scheme
FROM {_FLAGS_SQL}
""")
def flags_with_default(spark, sf):
    ev = Tables(spark, sf).events
    js = F.concat(F.lit('{"fig": "'), F.when(F.col("value") > 100, "Y").otherwise("n"), F.lit('", "table": "'),
                  F.when(F.col("event_type") == "click", " y ").otherwise("maybe"), F.lit('"}'))
    return ev.select("event_id", *T.flags_with_default(js, ["fig", "table", "scheme"]))


_TEMPLATE = "Source: {source}\nLanguage: {lang}\n\n{text}\n\nAnswer Y or N, then a rationale."


@register("render_prompt", sql="""
WITH p AS (SELECT doc_id, 'Source: ' || coalesce(source, '') || chr(10) || 'Language: ' || coalesce(lang, '') ||
                  chr(10) || chr(10) || coalesce(text, '') || chr(10) || chr(10) ||
                  'Answer Y or N, then a rationale.' AS prompt FROM documents)
SELECT doc_id, length(prompt)::INTEGER AS n_chars, md5(prompt) AS digest FROM p
""")
def render_prompt(spark, sf):
    d = Tables(spark, sf).documents
    p = T.render_prompt(_TEMPLATE, {"source": "source", "lang": "lang", "text": "text"})
    return d.select("doc_id", F.length(p).alias("n_chars"), F.md5(p).alias("digest"))


# ------------------------------------------------------------- vectors
_CENTROID_SQL = """(SELECT label, list(m ORDER BY pos) AS centroid FROM (
    SELECT label, pos, avg(x) AS m FROM (
      SELECT label, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings)
    GROUP BY label, pos) GROUP BY label)"""


@register("vector_ops", sql=f"""
WITH c AS {_CENTROID_SQL},
e AS (SELECT vec_id, e.label, list_transform(embedding, lambda x: x::DOUBLE) AS v, c.centroid FROM embeddings e JOIN c USING (label))
SELECT vec_id, label, round(sqrt(list_sum(list_transform(v, lambda x: x * x))), 6) AS norm,
       round(list_sum(list_transform(list_zip(v, centroid), lambda p: p[1] * p[2])), 6) AS dot,
       round(CASE WHEN sqrt(list_sum(list_transform(v, lambda x: x * x))) = 0 OR sqrt(list_sum(list_transform(centroid, lambda x: x * x))) = 0
                  THEN 0.0 ELSE list_sum(list_transform(list_zip(v, centroid), lambda p: p[1] * p[2]))
                       / (sqrt(list_sum(list_transform(v, lambda x: x * x))) * sqrt(list_sum(list_transform(centroid, lambda x: x * x)))) END, 6) AS cosine,
       round(sqrt(list_sum(list_transform(list_zip(v, centroid), lambda p: (p[1] - p[2]) * (p[1] - p[2])))), 6) AS euclid
FROM e
""")
def vector_ops(spark, sf):
    em = Tables(spark, sf).embeddings
    c = V.centroids(em, "label", "embedding")
    j = em.join(c, "label")
    return j.select("vec_id", "label", rnd(V.l2norm("embedding")).alias("norm"),
                    rnd(V.dot("embedding", "centroid")).alias("dot"),
                    rnd(V.cosine("embedding", "centroid")).alias("cosine"),
                    rnd(V.euclid("embedding", "centroid")).alias("euclid"))


@register("minmax_array", sql="""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)
SELECT vec_id, CASE WHEN list_max(v) = list_min(v) THEN list_transform(v, lambda x: round(x, 6))
                    ELSE list_transform(v, lambda x: round((x - list_min(v)) / (list_max(v) - list_min(v)), 6)) END AS scaled
FROM e
""")
def minmax_array(spark, sf):
    em = Tables(spark, sf).embeddings
    return em.select("vec_id", F.transform(V.minmax_array("embedding"), lambda x: F.round(x, 6)).alias("scaled"))


@register("merge_vectors", sql=f"""
WITH c AS {_CENTROID_SQL},
m AS (SELECT vec_id, list_transform(list_zip(list_transform(embedding, lambda x: x::DOUBLE), centroid),
                                    lambda p: (p[1] + p[2]) / 2.0) AS v FROM embeddings JOIN c USING (label)),
n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS nv FROM m)
SELECT vec_id, CASE WHEN nv = 0 THEN list_transform(v, lambda x: round(x, 6))
                    ELSE list_transform(v, lambda x: round(x / nv, 6)) END AS merged FROM n
""")
def merge_vectors(spark, sf):
    em = Tables(spark, sf).embeddings
    j = em.join(V.centroids(em, "label", "embedding"), "label")
    return j.select("vec_id", F.transform(V.merge_vectors("embedding", "centroid"), lambda x: F.round(x, 6)).alias("merged"))


# ------------------------------------------------------------- conditions
@register("format_recipe", sql=f"""
SELECT DISTINCT {', '.join(CONDS)}, concat_ws(', ', 'flag=' || l_returnflag, 'status=' || l_linestatus,
       'disc=' || l_discount::VARCHAR, 'tax=' || l_tax::VARCHAR) AS recipe FROM lineitem
""")
def format_recipe(spark, sf):
    r = runs(spark, sf).select(*CONDS).distinct()
    return r.select(*CONDS, S.format_recipe([("flag", "l_returnflag"), ("status", "l_linestatus"),
                                             ("disc", "l_discount"), ("tax", "l_tax")]).alias("recipe"))


@register("augment_conditions", sql=f"""
SELECT l_orderkey, l_linenumber,
       round(greatest(1.0, least(50.0, l_quantity + {_normal_sql(_KEY, '5:l_quantity')} * 1.0)), 6) AS l_quantity,
       round(greatest(0.0, least(0.1, l_discount * (1.0 + {_normal_sql(_KEY, '5:l_discount')} * 0.1))), 6) AS l_discount
FROM lineitem
""")
def augment_conditions(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    key = F.concat_ws(":", "l_orderkey", "l_linenumber")
    return S.augment_conditions(li, key, {"l_quantity": 1.0}, {"l_discount": 0.1},
                                {"l_quantity": (1.0, 50.0), "l_discount": (0.0, 0.1)}, seed=5)


def _question_replies(spark, sf):
    cv = Tables(spark, sf).conversations
    key = F.concat_ws(":", "conv_id", "turn")
    yn = lambda seed: F.when(md5_unit(key, seed) < 0.5, "y").otherwise("N")
    q3 = F.when(md5_unit(key, "q3") < 0.5, F.concat(F.lit("\nQ3: "), yn("a3"), F.lit("\nRational: short"))).otherwise("")
    reply = F.concat(F.lit("Q1: "), yn("a1"), F.lit("\nRationale: r1 "), F.md5("text"), F.lit("\nQ2: "), yn("a2"), q3)
    return cv.select("conv_id", "turn", reply.alias("reply"))


def _yn_sql(seed):
    k = "concat(conv_id::VARCHAR, ':', turn::VARCHAR)"
    return f"CASE WHEN {_u(k, seed)} < 0.5 THEN 'y' ELSE 'N' END"


_QREPLY_SQL = f"""(SELECT conv_id, turn, 'Q1: ' || {_yn_sql('a1')} || chr(10) || 'Rationale: r1 ' || md5(text) || chr(10) ||
  'Q2: ' || {_yn_sql('a2')} ||
  CASE WHEN {_u("concat(conv_id::VARCHAR, ':', turn::VARCHAR)", 'q3')} < 0.5
       THEN chr(10) || 'Q3: ' || {_yn_sql('a3')} || chr(10) || 'Rational: short' ELSE '' END AS reply
  FROM conversations)"""


@register("parse_questions", sql=rf"""
WITH l AS (SELECT conv_id, turn, generate_subscripts(regexp_split_to_array(reply, '\r?\n'), 1) AS pos,
                  trim(unnest(regexp_split_to_array(reply, '\r?\n')), ' ') AS line FROM {_QREPLY_SQL}),
q AS (SELECT *, CASE WHEN regexp_extract(line, '^Q([0-9]+)\s*:', 1) <> '' THEN 'Q' || regexp_extract(line, '^Q([0-9]+)\s*:', 1) END AS qq
      FROM l),
c AS (SELECT *, last_value(qq IGNORE NULLS) OVER (PARTITION BY conv_id, turn ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cur,
             CASE WHEN qq IS NOT NULL THEN upper(trim(regexp_extract(line, '^Q[0-9]+\s*:\s*(.*)$', 1), ' ')) END AS ans,
             CASE WHEN qq IS NULL AND regexp_matches(lower(line), '^rationale?\s*:') THEN trim(regexp_extract(line, '^[^:]*:(.*)$', 1), ' ') END AS why
      FROM q),
g AS (SELECT conv_id, turn, cur, arg_min(ans, pos) FILTER (WHERE ans IS NOT NULL) AS flag,
             arg_min(why, pos) FILTER (WHERE why IS NOT NULL) AS reason FROM c GROUP BY conv_id, turn, cur)
SELECT b.conv_id, b.turn,
       coalesce(max(CASE WHEN cur = 'Q1' THEN flag END), '') AS Q1_flag, coalesce(max(CASE WHEN cur = 'Q1' THEN reason END), '') AS Q1_reason,
       coalesce(max(CASE WHEN cur = 'Q2' THEN flag END), '') AS Q2_flag, coalesce(max(CASE WHEN cur = 'Q2' THEN reason END), '') AS Q2_reason,
       coalesce(max(CASE WHEN cur = 'Q3' THEN flag END), '') AS Q3_flag, coalesce(max(CASE WHEN cur = 'Q3' THEN reason END), '') AS Q3_reason
FROM (SELECT DISTINCT conv_id, turn FROM conversations) b LEFT JOIN g USING (conv_id, turn) GROUP BY b.conv_id, b.turn
""")
def parse_questions(spark, sf):
    return T.parse_questions(_question_replies(spark, sf), ["conv_id", "turn"], "reply", ["Q1", "Q2", "Q3"])


def _props_json(spark, sf):
    pa = Tables(spark, sf).part
    dup = F.when(md5_unit("p_partkey", "dup") < 0.3, F.lit(',{"label":"size","value":{"sval":"dup"}}')).otherwise("")
    js = F.concat(F.lit('[{"label":"size","value":{"ival":'), F.col("p_size").cast("string"),
                  F.lit('}},{"label":"price","value":{"fval":'), F.col("p_retailprice").cast("string"),
                  F.lit('}},{"label":"brand","value":{"sval":"'), F.col("p_brand"), F.lit('"}}'), dup, F.lit("]"))
    return pa.select("p_partkey", js.alias("js"))


@register("props_to_fields", sql=f"""
WITH j AS (SELECT p_partkey, '[{{"label":"size","value":{{"ival":' || p_size::VARCHAR || '}}}},{{"label":"price","value":{{"fval":' ||
                  p_retailprice::VARCHAR || '}}}},{{"label":"brand","value":{{"sval":"' || p_brand || '"}}}}' ||
                  CASE WHEN {_u('p_partkey', 'dup')} < 0.3 THEN ',{{"label":"size","value":{{"sval":"dup"}}}}' ELSE '' END || ']' AS js
           FROM part),
e AS (SELECT p_partkey, unnest(json_transform(js, '[{{"label":"VARCHAR","value":{{"sval":"VARCHAR","fval":"DOUBLE","ival":"BIGINT"}}}}]')) AS p,
             generate_subscripts(json_transform(js, '[{{"label":"VARCHAR","value":{{"sval":"VARCHAR","fval":"DOUBLE","ival":"BIGINT"}}}}]'), 1) AS i
      FROM j),
v AS (SELECT p_partkey, i, p.label AS label, coalesce(p.value.sval, p.value.fval::VARCHAR, p.value.ival::VARCHAR) AS value FROM e)
SELECT p_partkey, arg_min(value, i) FILTER (WHERE label = 'size') AS size,
       arg_min(value, i) FILTER (WHERE label = 'price') AS price, arg_min(value, i) FILTER (WHERE label = 'brand') AS brand
FROM v GROUP BY p_partkey
""")
def props_to_fields(spark, sf):
    return T.props_to_fields(_props_json(spark, sf), "p_partkey", "js", ["size", "price", "brand"])


def _peaks(v):
    """Three peaks from a vector's first nine components."""
    e = lambda j: F.col(v)[j].cast("double")
    return [(F.lit(500.0 + 500.0 * j) + F.lit(200.0) * e(j), F.lit(20.0) + F.lit(10.0) * F.abs(e(3 + j)),
             F.lit(0.5) + F.abs(e(6 + j))) for j in range(3)]


def _peaks_sql_at(x):
    terms = []
    for j in range(3):
        mu = f"(500.0 + 500.0 * {j} + 200.0 * embedding[{j + 1}]::DOUBLE)"
        sig = f"(20.0 + 10.0 * abs(embedding[{4 + j}]::DOUBLE))"
        amp = f"(0.5 + abs(embedding[{7 + j}]::DOUBLE))"
        terms.append(f"{amp} * exp(-0.5 * (({x} - {mu}) / {sig}) * (({x} - {mu}) / {sig}))")
    return "(0.0 + " + " + ".join(terms) + ")"


_X_SQL = "(400.0 + i * (1400.0 / 599))"


@register("spectrum_base", sql=f"""
SELECT vec_id, list_transform(range(600), lambda i: round({_peaks_sql_at(_X_SQL)}, 6)) AS spectrum FROM embeddings
""")
def spectrum_base(spark, sf):
    from vialflow.functions import spectra as SP
    em = Tables(spark, sf).embeddings
    return em.select("vec_id", F.transform(SP.spectrum(_peaks("embedding")), lambda x: F.round(x, 6)).alias("spectrum"))


def _n_sql(key):
    h = f"md5({key})"
    return (f"(sqrt(-2.0 * ln(1.0 - (('0x' || substr({h}, 1, 8))::UBIGINT / 4294967296.0))) * "
            f"cos(2.0 * pi() * (('0x' || substr({h}, 9, 8))::UBIGINT / 4294967296.0)))")


@register("spectrum_views", sql=f"""
WITH s AS (SELECT vec_id, vec_id::VARCHAR || ':3' AS k,
                  list_transform(range(600), lambda i: {_peaks_sql_at(_X_SQL)}) AS spec FROM embeddings),
a AS (SELECT vec_id, list_transform(range(600), lambda i:
        (spec[i + 1] + {_n_sql("k || ':slope'")} * 0.0004 * (i - 299.5) + {_n_sql("k || ':' || i::VARCHAR")} * 0.02)
        * (1.0 + {_n_sql("k || ':scale'")} * 0.03)) AS aug FROM s),
b AS (SELECT vec_id, aug, list_min(aug) AS lo, list_max(aug) AS hi FROM a)
SELECT vec_id, CASE WHEN hi - lo < 1e-9 THEN list_transform(aug, lambda v: round(v, 6))
                    ELSE list_transform(aug, lambda v: round((v - lo) / (hi - lo), 6)) END AS view
FROM b
""")
def spectrum_views(spark, sf):
    from vialflow.functions import spectra as SP
    em = Tables(spark, sf).embeddings
    base = em.select("vec_id", SP.spectrum(_peaks("embedding")).alias("_s"))
    aug = base.select("vec_id", SP.augment(F.col("_s"), F.col("vec_id"), 3).alias("_a"))
    return aug.select("vec_id", F.transform(SP.minmax(F.col("_a")), lambda x: F.round(x, 6)).alias("view"))


def _u_sql(key):
    return f"(('0x' || substr(md5({key}), 1, 8))::UBIGINT / 4294967296.0)"


@register("array_views", sql=f"""
WITH s AS (SELECT vec_id, embedding::DOUBLE[] AS y, len(embedding) AS n,
                  floor({_u_sql("vec_id::VARCHAR || ':5:shift'")} * 9)::BIGINT - 4 AS shift,
                  1.0 + {_n_sql("vec_id::VARCHAR || ':5:stretch'")} * 0.015 AS scale,
                  {_u_sql("vec_id::VARCHAR || ':5:band'")} < 0.5 AS band,
                  least(floor({_u_sql("vec_id::VARCHAR || ':5:width'")} * 30)::BIGINT + 6, len(embedding)) AS width
           FROM embeddings WHERE len(embedding) > 1),
places AS (SELECT *, list_transform(range(n), lambda i: least(greatest((i - shift) * scale, 0), n - 1)) AS x FROM s),
points AS (SELECT vec_id, unnest(x) AS x, unnest(y) AS y, generate_subscripts(x, 1) AS i FROM places),
parts AS (SELECT vec_id, x AS x0, y AS y0, i, lead(x) OVER w AS x1, lead(y) OVER w AS y1,
                 first_value(x) OVER w AS xa, first_value(y) OVER w AS ya
          FROM points WINDOW w AS (PARTITION BY vec_id ORDER BY i)),
ends AS (SELECT vec_id, max_by(x0, i) AS xz, max_by(y0, i) AS yz, any_value(xa) AS xa, any_value(ya) AS ya FROM parts GROUP BY vec_id),
cells AS (SELECT vec_id, unnest(range(n)) AS j FROM s),
inner_ AS (SELECT cells.vec_id, j, y0 + (y1 - y0) * (j - x0) / (x1 - x0) AS v
           FROM cells JOIN parts ON cells.vec_id = parts.vec_id AND j >= x0 AND j < x1),
warped AS (SELECT cells.vec_id, list(CASE WHEN j >= xz THEN yz WHEN j < xa THEN ya ELSE v END ORDER BY j) AS w
           FROM cells JOIN ends USING (vec_id) LEFT JOIN inner_ USING (vec_id, j) GROUP BY cells.vec_id),
starts AS (SELECT vec_id, w, band, width, floor({_u_sql("vec_id::VARCHAR || ':5:start'")} * (n - width + 1))::BIGINT AS start
           FROM warped JOIN s USING (vec_id)),
dropped AS (SELECT vec_id, list_transform(range(len(w)), lambda i: CASE WHEN band AND i >= start AND i < start + width
                THEN 0.2::DOUBLE * (w[start + 1] + (w[start + width] - w[start + 1]) * (i - start) / greatest(width - 1, 1))
                ELSE w[i + 1] END) AS d FROM starts),
bounds AS (SELECT vec_id, d, list_min(d) AS lo, list_max(d) AS hi FROM dropped)
SELECT vec_id, list_transform(d, lambda v: round(CASE WHEN hi - lo < 1e-9 THEN v ELSE (v - lo) / (hi - lo) END, 6)) AS view FROM bounds
""")
def array_views(spark, sf):
    """Warped and masked views of all components of every vector."""
    from vialflow.functions import spectra as SP
    em = Tables(spark, sf).embeddings.where(F.size("embedding") > 1)
    view = SP.array_view(F.col("embedding"), F.col("vec_id"), 5)
    return em.select("vec_id", F.transform(view, lambda x: F.round(x, 6)).alias("view"))


def _records(spark, sf):
    """One nested record per region: a region section with one subsection per
    nation, each nation with a 'Suppliers' subsection (strings from the
    tables)."""
    t = Tables(spark, sf)
    sup = t.supplier.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("n_sup"), F.max("s_name").alias("top_sup"))
    nat = t.nation.join(sup, "n_nationkey", "left")
    info = lambda c: F.array(F.struct(F.struct(F.array(F.struct(c.alias("String"))).alias("StringWithMarkup"))
                                      .alias("Value")))
    nsec = F.struct(F.col("n_name").alias("TOCHeading"),
                    info(F.concat(F.col("n_name"), F.lit(" nation"))).alias("Information"),
                    F.array(F.struct(F.lit("Suppliers").alias("TOCHeading"),
                                     info(F.concat(F.lit("suppliers: "), F.coalesce(F.col("n_sup"), F.lit(0)).cast("string"),
                                                   F.lit(", top "), F.coalesce(F.col("top_sup"), F.lit("none")))).alias("Information"),
                                     F.array(F.struct(F.concat("n_name", F.lit(" detail")).alias("TOCHeading"),
                                                      info(F.lit("fourth level")).alias("Information"))).alias("Section")))
                    .alias("Section"))
    per_region = nat.groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(
        F.array_sort(F.collect_list(F.struct("n_nationkey", nsec.alias("sec")))).alias("_n"))
    reg = t.region.join(per_region, "r_regionkey", "left")
    rsec = F.struct(F.concat(F.lit("Region "), F.col("r_name")).alias("TOCHeading"),
                    info(F.concat(F.lit("key "), F.col("r_regionkey").cast("string"))).alias("Information"),
                    F.transform(F.coalesce("_n", F.array()), lambda x: x["sec"]).alias("Section"))
    return reg.select("r_regionkey", F.to_json(F.struct(F.struct(F.array(rsec).alias("Section")).alias("Record"))).alias("js"))


@register("find_sections", sql="""
WITH s AS (SELECT s_nationkey AS k, count(*) AS n, max(s_name) AS top FROM supplier GROUP BY s_nationkey),
n AS (SELECT n_regionkey, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS i,
             'suppliers: ' || coalesce(s.n, 0) || ', top ' || coalesce(s.top, 'none') AS sup
      FROM nation LEFT JOIN s ON s.k = n_nationkey),
p AS (SELECT r_regionkey, '0.' || i AS place, n_name, ' > Region ' || r_name || ' > ' || n_name AS path, sup
      FROM n JOIN region ON r_regionkey = n_regionkey WHERE lower(n_name) LIKE '%nation\\_1%' ESCAPE '\\')
SELECT r_regionkey, place AS "order", n_name AS title, path, n_name || ' nation' || chr(10) || sup || chr(10) || 'fourth level' AS text,
       3 AS n_lines FROM p
UNION ALL SELECT r_regionkey, place || '.0.0', n_name || ' detail', path || ' > Suppliers > ' || n_name || ' detail', 'fourth level', 1 FROM p
""")
def find_sections(spark, sf):
    """Sections whose title contains 'nation_1' in per-region nested records,
    with path, up to 12 text lines and the number of lines."""
    return T.find_sections(_records(spark, sf), "r_regionkey", "js", "nation_1", 12)
