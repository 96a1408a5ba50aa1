"""Section N: literature and text mining (plus D14 page matrix)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vialflow.functions.hashing import md5_unit
from vialflow.operators import mining as N
from vialflow.plans.columns import _u
from vialflow.plans.registry import register
from vialflow.sources.tables import Tables


def _rm(pat):
    """Pattern as a SQL string literal."""
    return "'" + pat.replace("'", "''") + "'"


def _screen_sql(src="documents"):
    hits = {n: f"regexp_matches(text, {_rm(p)})" for _k, n, p in N.DEFAULT_RULES}
    excl = " OR ".join(hits[n] for k, n, _p in N.DEFAULT_RULES if k == "exclusion")
    strong = " OR ".join(hits[n] for k, n, _p in N.DEFAULT_RULES if k == "strong")
    weak = " + ".join(f"({hits[n]})::INTEGER" for k, n, _p in N.DEFAULT_RULES if k == "weak")
    order = [n for k in ("exclusion", "strong", "weak") for kk, n, _p in N.DEFAULT_RULES if kk == k]
    rat = " ".join(f"WHEN {hits[n]} THEN '{n}'" for n in order)
    return f"""(SELECT doc_id, CASE WHEN {excl} THEN 'N' WHEN {strong} THEN 'Y' WHEN {weak} >= 2 THEN 'Y' ELSE 'N' END AS label,
  CASE {rat} ELSE 'no cue' END AS rationale, {weak} AS n_weak FROM {src})"""


@register("screen", sql=f"SELECT * FROM {_screen_sql()}")
def screen(spark, sf):
    d = Tables(spark, sf).documents.select("doc_id", "text")
    return N.screen(d, "text").drop("text")


_SIMPLE = r"Released under the|token ="


@register("screen_simple", sql=f"""
SELECT doc_id, CASE WHEN regexp_matches(text, {_rm(_SIMPLE)}) THEN 'Y' ELSE 'N' END AS label FROM documents
""")
def screen_simple(spark, sf):
    d = Tables(spark, sf).documents.select("doc_id", "text")
    return N.screen_simple(d, "text", _SIMPLE).drop("text")


@register("compare_screens", sql=f"""
WITH a AS {_screen_sql()},
b AS (SELECT doc_id, CASE WHEN regexp_matches(text, {_rm(_SIMPLE)}) THEN 'Y' ELSE 'N' END AS label FROM documents)
SELECT a.label AS label_a, b.label AS label_b, count(*) AS n, a.label = b.label AS agree
FROM a JOIN b USING (doc_id) GROUP BY a.label, b.label
""")
def compare_screens(spark, sf):
    d = Tables(spark, sf).documents.select("doc_id", "text")
    return N.compare_screens(N.screen(d, "text"), N.screen_simple(d, "text", _SIMPLE), "doc_id")


@register("selected", sql=f"SELECT doc_id, rationale FROM {_screen_sql()} WHERE label = 'Y'")
def selected(spark, sf):
    d = Tables(spark, sf).documents.select("doc_id", "text")
    return N.selected(N.screen(d, "text")).select("doc_id", "rationale")


_STRIP_SQL = r"""trim(regexp_replace(replace(replace(replace(
  regexp_replace(regexp_replace(html, '(?s)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g'),
  '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g'))"""


def _doc_key():
    return F.regexp_extract("url", r"^https?://([^/?#]+)", 1)


def _page_no():
    n = F.regexp_extract("url", r"[?&]page=([0-9]+)", 1)
    return F.when(n == "", F.lit(1)).otherwise(n.cast("int"))


@register("full_text", sql=f"""
WITH p AS (SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS doc,
                  coalesce(TRY_CAST(nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') AS INTEGER), 1) AS page_no,
                  page_id, {_STRIP_SQL} AS text FROM pages)
SELECT doc, page_id, row_number() OVER (PARTITION BY doc ORDER BY page_no, page_id)::INTEGER AS page_order,
       md5(text) AS digest, length(text)::INTEGER AS n_chars, substr(text, 1, 200) AS head FROM p
""")
def full_text(spark, sf):
    pg = Tables(spark, sf).pages
    ft = N.full_text(pg, _doc_key(), _page_no(), "html", "page_id")
    return ft.select("doc", "page_id", "page_order", F.md5("text").alias("digest"), "n_chars", "head")


@register("repair_text", sql=r"""
WITH d AS (SELECT doc_id, regexp_replace(text, '(\p{L})-\r?\n(\p{L})', '\1\2', 'g') AS t FROM documents),
l AS (SELECT doc_id, unnest(regexp_split_to_array(t, '\r?\n')) AS line,
             generate_subscripts(regexp_split_to_array(t, '\r?\n'), 1) AS ln FROM d),
k AS (SELECT doc_id, ln, trim(line, ' ') AS key FROM l),
f AS (SELECT key FROM (SELECT DISTINCT doc_id, key FROM k WHERE key <> '') GROUP BY key HAVING count(*) >= 3),
r AS (SELECT doc_id, string_agg(key, ' ' ORDER BY ln) AS repaired FROM k WHERE key <> '' AND key NOT IN (SELECT key FROM f)
      GROUP BY doc_id)
SELECT doc_id, md5(coalesce(repaired, '')) AS digest, length(coalesce(repaired, ''))::INTEGER AS n_chars
FROM documents LEFT JOIN r USING (doc_id)
""")
def repair_text(spark, sf):
    d = Tables(spark, sf).documents
    r = N.repair_text(d, "doc_id", "text", 3)
    return r.select("doc_id", F.md5("repaired").alias("digest"), F.length("repaired").alias("n_chars"))


@register("chunk_text", sql=r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 10 - 1, 0) + 1, 40)) AS st FROM w),
c AS (SELECT doc_id, w, st, (row_number() OVER (PARTITION BY doc_id ORDER BY st) - 1)::INTEGER AS chunk_no FROM s)
SELECT doc_id, chunk_no, len(w[st + 1 : st + 50])::INTEGER AS n_words, md5(array_to_string(w[st + 1 : st + 50], ' ')) AS digest
FROM c WHERE st < len(w) OR (len(w) = 0 AND st = 0)
""")
def chunk_text(spark, sf):
    c = N.chunk(Tables(spark, sf).documents, "doc_id", "text", 50, 10)
    return c.select("doc_id", "chunk_no", "n_words", F.md5("text").alias("digest"))


@register("extract_conditions", sql=r"""
WITH e AS (SELECT doc_id, regexp_extract_all(text, '([0-9]+(?:\.[0-9]+)?)\s*([A-Za-z%]+)', 1) AS v,
                  regexp_extract_all(text, '([0-9]+(?:\.[0-9]+)?)\s*([A-Za-z%]+)', 2) AS u FROM documents)
SELECT doc_id, (generate_subscripts(v, 1) - 1)::INTEGER AS pos, unnest(v)::DOUBLE AS value, unnest(u) AS unit FROM e
""")
def extract_conditions(spark, sf):
    return N.extract_conditions(Tables(spark, sf).documents, "doc_id", "text")


# Recipe texts: part, quantity and line of an order as sentences.
_RECIPE_SQL = """(SELECT l_orderkey * 10 + l_linenumber AS rid, 'Take ' || p_name || '. Heat ' || p_brand || ' in ' || split_part(p_type, ' ', 1)
  || ' at ' || l_quantity::INTEGER || CASE WHEN l_linenumber % 2 = 0 THEN ' C' ELSE ' K' END || ' for '
  || (l_orderkey % 90 + 1) || CASE WHEN l_returnflag = 'N' THEN ' h' ELSE ' min' END
  || ' then cool slowly and filter the solid off before washing it twice with plenty of cold solvent! Stored dry.' AS text
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


@register("condition_records", sql=rf"""
WITH s AS (SELECT rid, unnest(regexp_split_to_array(text, '[.!?]\s+|\n+')) AS s,
                  generate_subscripts(regexp_split_to_array(text, '[.!?]\s+|\n+'), 1) - 1 AS pos FROM {_RECIPE_SQL}),
e AS (SELECT rid, pos, s, TRY_CAST(nullif(regexp_extract(s, '(-?[0-9]+(?:\.[0-9]+)?)\s*(?:°\s*)?(C|K)\b', 1), '') AS DOUBLE) AS t,
             regexp_extract(s, '(-?[0-9]+(?:\.[0-9]+)?)\s*(?:°\s*)?(C|K)\b', 2) AS tu,
             TRY_CAST(nullif(regexp_extract(s, '([0-9]+(?:\.[0-9]+)?)\s*(h|hr|hrs|hour|hours|min|minute|minutes)\b', 1), '') AS DOUBLE) AS d,
             regexp_extract(s, '([0-9]+(?:\.[0-9]+)?)\s*(h|hr|hrs|hour|hours|min|minute|minutes)\b', 2) AS du,
             nullif(regexp_extract(s, '\bin\s+([A-Za-z][A-Za-z0-9-]*)', 1), '') AS solvent FROM s)
SELECT rid, pos::INTEGER AS pos, round(CASE WHEN tu = 'K' THEN t - 273.15 ELSE t END, 6) AS temperature_c,
       round(CASE WHEN du LIKE 'min%' THEN d / 60.0 ELSE d END, 6) AS time_h, solvent,
       array_to_string(list_filter(regexp_split_to_array(s, '\s+'), lambda w: w <> '')[1:15], ' ') AS note
FROM e WHERE t IS NOT NULL OR d IS NOT NULL
""")
def condition_records(spark, sf):
    """Temperature, time, solvent and note out of recipe sentences."""
    t = Tables(spark, sf)
    j = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    text = F.concat(F.lit("Take "), "p_name", F.lit(". Heat "), "p_brand", F.lit(" in "), F.split_part("p_type", F.lit(" "), F.lit(1)),
                    F.lit(" at "), F.col("l_quantity").cast("int").cast("string"),
                    F.when(F.col("l_linenumber") % 2 == 0, F.lit(" C")).otherwise(F.lit(" K")), F.lit(" for "),
                    (F.col("l_orderkey") % 90 + 1).cast("string"), F.when(F.col("l_returnflag") == "N", F.lit(" h")).otherwise(F.lit(" min")),
                    F.lit(" then cool slowly and filter the solid off before washing it twice with plenty of cold solvent! Stored dry."))
    r = N.condition_records(j.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("rid"), text.alias("text")), "rid", "text")
    return r.withColumns({"temperature_c": F.round("temperature_c", 6), "time_h": F.round("time_h", 6)})


# Synonym table for the entity-normalisation example.
SYNONYMS = [("red widget", "widget"), ("blue widget", "widget"), ("small ring", "ring"), ("big ring", "ring")]


def _variants(spark, sf):
    pa = Tables(spark, sf).part
    u = md5_unit("p_partkey", "var")
    v = (F.when(u < 0.25, F.upper("p_name")).when(u < 0.5, F.regexp_replace("p_name", " ", "-"))
         .when(u < 0.75, F.concat(F.lit("  "), F.col("p_name"), F.lit("."))).otherwise(F.col("p_name")))
    return pa.select("p_partkey", v.alias("name"))


@register("normalise_entity", sql=rf"""
WITH v AS (SELECT p_partkey, CASE WHEN {_u("p_partkey", "var")} < 0.25 THEN upper(p_name)
                                  WHEN {_u("p_partkey", "var")} < 0.5 THEN replace(p_name, ' ', '-')
                                  WHEN {_u("p_partkey", "var")} < 0.75 THEN '  ' || p_name || '.' ELSE p_name END AS name
           FROM part),
n AS (SELECT p_partkey, name, trim(regexp_replace(regexp_replace(lower(name), '[\s\-_.]+', ' ', 'g'), '[^\p{{L}}\p{{N}} ]', '', 'g'), ' ') AS nn FROM v),
s AS (SELECT * FROM (VALUES {", ".join(f"('{a}', '{b}')" for a, b in SYNONYMS)}) t(variant, canon))
SELECT p_partkey, name, coalesce(s.canon, nn) AS entity FROM n LEFT JOIN s ON s.variant = n.nn
""")
def normalise_entity(spark, sf):
    syn = spark.createDataFrame(SYNONYMS, "variant string, canonical string")
    return N.resolve_synonyms(_variants(spark, sf), "name", syn)


@register("classify_sentences", sql=r"""
WITH s AS (SELECT conv_id, turn, list_filter(list_transform(
             regexp_split_to_array(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), '[' || chr(1) || chr(10) || ']+'),
             lambda x: trim(x, ' ')), lambda x: x <> '') AS ss FROM conversations),
e AS (SELECT conv_id, turn, (generate_subscripts(ss, 1) - 1)::INTEGER AS sent_no, unnest(ss) AS sentence FROM s)
SELECT conv_id, turn, sent_no,
       CASE WHEN regexp_matches(sentence, '\?\s*$') THEN 'question'
            WHEN regexp_matches(sentence, '^(Please|Use|Add|Run|Try|Set|Do|Check)([\s,.;:!?]|$)') THEN 'instruction'
            WHEN regexp_matches(sentence, ',.*,.*,') THEN 'listing' ELSE 'statement' END AS class,
       length(sentence)::INTEGER AS n_chars FROM e
""")
def classify_sentences(spark, sf):
    return N.classify_sentences(Tables(spark, sf).conversations, ["conv_id", "turn"], "text")


@register("assemble_history", sql="""
WITH l AS (SELECT conv_id, turn, role, text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rk FROM conversations)
SELECT conv_id, list(turn::VARCHAR || ' ' || role || ': ' || text ORDER BY turn, role, text) AS history,
       count(*) AS n_turns FROM l WHERE rk <= 4 GROUP BY conv_id
""")
def assemble_history(spark, sf):
    h = N.assemble_history(Tables(spark, sf).conversations, "conv_id", "turn", "role", "text", 4)
    return h.withColumn("history", F.transform("history", lambda m: F.concat(m["turn"].cast("string"), F.lit(" "), m["role"],
                                                                           F.lit(": "), m["content"])))


@register("follow_ups", sql="""
SELECT conv_id, turn, role, max(CASE WHEN role = 'user' THEN turn END) OVER (
  PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS follows_user_turn
FROM conversations
""")
def follow_ups(spark, sf):
    return N.follow_ups(Tables(spark, sf).conversations, "conv_id", "turn", "role")


# Tool specifications for the routing example (tool = event type).
TOOL_SPECS = {"click": {"k": "number"}, "view": {"k": "number"},
              "purchase": {"k": "number", "amount": "number"}, "error": {"code": "string"}}


_ROUTED_SQL = r"""(WITH c AS (SELECT event_id, user_id, ts, event_type AS tool,
                  CASE WHEN json_valid(props) AND json_type(props) = 'OBJECT' THEN props END AS js FROM events),
k AS (SELECT *, list_sort(json_keys(js)) AS keys,
        CASE tool WHEN 'click' THEN ['k'] WHEN 'view' THEN ['k'] WHEN 'purchase' THEN ['k', 'amount'] WHEN 'error' THEN ['code'] END AS names FROM c),
e AS (SELECT *,
        CASE WHEN names IS NULL THEN 'unknown tool' WHEN js IS NULL THEN 'bad json'
             WHEN len(list_filter(names, lambda a: NOT list_contains(keys, a))) > 0
                  THEN 'missing: ' || array_to_string(list_filter(names, lambda a: NOT list_contains(keys, a)), ',')
             WHEN len(list_filter(keys, lambda x: NOT list_contains(names, x))) > 0
                  THEN 'unexpected: ' || array_to_string(list_filter(keys, lambda x: NOT list_contains(names, x)), ',')
             WHEN tool <> 'error' AND NOT json_type(js, '$.k') IN ('BIGINT', 'UBIGINT', 'HUGEINT', 'DOUBLE') THEN 'wrong type'
             WHEN tool = 'purchase' AND NOT json_type(js, '$.amount') IN ('BIGINT', 'UBIGINT', 'HUGEINT', 'DOUBLE') THEN 'wrong type'
             WHEN tool = 'error' AND json_type(js, '$.code') <> 'VARCHAR' THEN 'wrong type' END AS error FROM k)
SELECT event_id, user_id, ts, tool, error IS NULL AS ok, error,
       CASE WHEN error IS NULL THEN CASE WHEN tool IN ('click', 'view') THEN 'k=' || json_extract_string(js, '$.k')
            WHEN tool = 'purchase' THEN 'k=' || json_extract_string(js, '$.k') || ';amount=' || json_extract_string(js, '$.amount')
            WHEN tool = 'error' THEN 'code=' || json_extract_string(js, '$.code') END END AS call
FROM e)"""


def _routed(spark, sf):
    ev = Tables(spark, sf).events.select("event_id", F.col("event_type").alias("tool"), "props")
    return N.route_calls(ev, "event_id", "tool", "props", TOOL_SPECS)


@register("route_calls", sql=f"SELECT event_id, tool, ok, error, call FROM {_ROUTED_SQL}")
def route_calls(spark, sf):
    return _routed(spark, sf)


@register("turn_results", sql=f"""
SELECT user_id, ts::DATE::VARCHAR AS day, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id) AS place,
       event_id, tool, CASE WHEN ok THEN call ELSE 'error: ' || error END AS content FROM {_ROUTED_SQL}
""")
def turn_results(spark, sf):
    """Results of routed calls in order, a user's day as the turn."""
    at = Tables(spark, sf).events.select("event_id", "user_id", "ts", F.to_date("ts").cast("string").alias("day"))
    r = N.collect_results(_routed(spark, sf).join(at, "event_id"), ["user_id", "day"], ["ts", "event_id"])
    return r.select("user_id", "day", "place", "event_id", "tool", "content")


def _flags(spark, sf):
    pg = Tables(spark, sf).pages.select("page_id", _doc_key().alias("doc"), _page_no().alias("page_no"), "html")
    return N.page_flags(pg, ["page_id", "doc", "page_no"], "html")


_FLAGS_SQL = ("(SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS doc, "
              "coalesce(TRY_CAST(nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') AS INTEGER), 1) AS page_no, "
              + ", ".join(f"CASE WHEN regexp_matches(lower(html), {_rm(p)}) THEN 'Y' ELSE 'N' END AS {c}"
                          for c, p in N.PAGE_CATEGORIES) + " FROM pages)")


@register("page_flags", sql=f"SELECT * FROM {_FLAGS_SQL}")
def page_flags(spark, sf):
    return _flags(spark, sf)


_CATS = [c for c, _p in N.PAGE_CATEGORIES]


@register("page_matrix", sql=f"""
WITH f AS {_FLAGS_SQL},
l AS (UNPIVOT f ON {", ".join(_CATS)} INTO NAME category VALUE flag)
SELECT category, doc, string_agg('page ' || page_no::VARCHAR, ', ' ORDER BY page_no) AS pages
FROM l WHERE flag = 'Y' GROUP BY category, doc
""")
def page_matrix(spark, sf):
    return N.page_matrix(_flags(spark, sf).drop("page_id"), "doc", "page_no", _CATS)


@register("pages_for", sql=f"""
SELECT page_id, doc, page_no FROM {_FLAGS_SQL} WHERE advert = 'Y' ORDER BY doc, page_no, page_id LIMIT 10
""")
def pages_for(spark, sf):
    return N.pages_for(_flags(spark, sf), "advert", ["doc", "page_no", "page_id"], 10).select("page_id", "doc", "page_no")
