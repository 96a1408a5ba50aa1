"""Literature and text mining: rule screening, screener comparison, page
text, repair, chunking, condition extraction, entity normalisation,
sentence classification, chat history, tool-call routing and page flags.

Rules are small configuration lists (kind, name, pattern) turned into
column expressions when the plan is built; every text is processed whole,
in its own row. Corpus-level statistics (boilerplate line frequency) are
partial aggregates; per-document regrouping is bounded by one document.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vialflow.operators.window import RANGE, running
# Default screening cues (kind, name, pattern). They are data,
# not the method - the protocol (exclusion > strong > 2 weak) is what counts.
DEFAULT_RULES = [
    ("exclusion", "pipe_junk", r"\|[^|\n]*\|[^|\n]*\|"),
    ("strong", "license", r"Released under the"),
    ("weak", "email", r"[A-Za-z0-9._]+@[A-Za-z0-9.]+\.[a-z]+"),
    ("weak", "digit_run", r"[0-9]{4,}"),
    ("weak", "token", r"token ="),
    ("weak", "hashes", r"###"),
    ("weak", "percents", r"%%%"),
]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def screen(df: DataFrame, text: str, rules: Sequence[tuple[str, str, str]] = DEFAULT_RULES,
           min_weak: int = 2) -> DataFrame:
    """label: any exclusion -> N; else any strong -> Y; else >= min_weak weak
    cues -> Y; else N. rationale: the first matching cue in rule order of
    exclusion, strong, weak ('no cue' when none)."""
    t = F.col(text)
    # each cue is evaluated once per text (its own column), then combined
    hit_cols = {name: f"_hit_{i}" for i, (_k, name, _p) in enumerate(rules)}
    d = df.select("*", *[t.rlike(pat).alias(hit_cols[name]) for _k, name, pat in rules])
    hits = {name: F.col(c) for name, c in hit_cols.items()}
    excl = [n for k, n, _p in rules if k == "exclusion"]
    strong = [n for k, n, _p in rules if k == "strong"]
    weak = [n for k, n, _p in rules if k == "weak"]

    def any_of(names):
        e = F.lit(False)
        for n in names:
            e = e | hits[n]
        return e

    n_weak = F.lit(0)
    for n in weak:
        n_weak = n_weak + hits[n].cast("int")
    label = (F.when(any_of(excl), "N").when(any_of(strong), "Y").when(n_weak >= min_weak, "Y").otherwise("N"))
    rationale = None
    for n in excl + strong + weak:
        rationale = F.when(hits[n], F.lit(n)) if rationale is None else rationale.when(hits[n], F.lit(n))
    rationale = rationale.otherwise(F.lit("no cue"))
    return d.select(*df.columns, label.alias("label"), rationale.alias("rationale"), n_weak.alias("n_weak"))


def screen_simple(df: DataFrame, text: str, pattern: str) -> DataFrame:
    return df.select("*", F.when(F.col(text).rlike(pattern), "Y").otherwise("N").alias("label"))


def compare_screens(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Cross-tab of two screeners' labels on the same items (join on key)."""
    j = a.select(key, F.col("label").alias("label_a")).join(b.select(key, F.col("label").alias("label_b")), key)
    return j.groupBy("label_a", "label_b").agg(F.count(F.lit(1)).alias("n")).select(
        "label_a", "label_b", "n", (F.col("label_a") == F.col("label_b")).alias("agree"))


def selected(df: DataFrame, label: str = "label") -> DataFrame:
    return df.where(F.col(label) == "Y")


def strip_html(html: Column | str) -> Column:
    """Visible text: script/style blocks and tags removed, entities for
    &amp; &lt; &gt; decoded, whitespace collapsed."""
    h = _c(html)
    t = F.regexp_replace(h, r"(?s)<(script|style)[^>]*>.*?</(script|style)>", " ")
    t = F.regexp_replace(t, r"<[^>]*>", " ")
    t = F.replace(F.replace(F.replace(t, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&amp;"), F.lit("&"))
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def full_text(pages: DataFrame, doc: Column, page_no: Column, html: str, page_id: str, head: int = 200) -> DataFrame:
    """Per page: document key, order within the document, visible text, its
    length and its first ``head`` characters; the ordered rows are the document's
    full text (no single string per document is built). ``page_id`` is unique. Only
    keys are put in order, by a running count over ranges, so a document with very
    many pages is no single task's work and no text is sorted."""
    keys = pages.select(doc.alias("doc"), page_no.alias("page_no"), F.col(page_id), F.lit(1).alias("_one"))
    order = running(keys, ["page_no", page_id], {"page_order": ("count", "_one")}, ["doc"], block=RANGE)
    text = pages.select(page_id, strip_html(html).alias("text"))
    return order.join(text, page_id).select("doc", page_id, F.col("page_order").cast("int").alias("page_order"), "text",
                                            F.length("text").alias("n_chars"), F.substring("text", 1, head).alias("head"))


def repair_text(df: DataFrame, id_col: str, text: str, min_docs: int = 3) -> DataFrame:
    """Repair extracted text: hyphenated line ends are joined, lines that
    occur in at least ``min_docs`` documents (running headers/footers) are
    dropped, and the remaining lines are joined with spaces in order.

    Line frequency is a corpus-wide partial aggregate; the boilerplate set is
    removed with a join; each document's kept lines are re-joined in order
    (one document per group)."""
    t = F.regexp_replace(F.col(text), r"(\p{L})-\r?\n(\p{L})", "$1$2")
    lines = df.select(id_col, F.posexplode(F.split(t, r"\r?\n")).alias("_ln", "_line"))
    lines = lines.withColumn("_key", F.trim("_line"))
    freq = (lines.where(F.col("_key") != "").select(id_col, "_key").distinct()
            .groupBy("_key").agg(F.count(F.lit(1)).alias("_ndocs")).where(F.col("_ndocs") >= min_docs))
    kept = lines.join(freq.select("_key"), "_key", "left_anti").where(F.col("_key") != "")
    out = kept.groupBy(id_col).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_ln", "_key"))),
                                                            lambda s: s["_key"]), " ").alias("repaired"))
    return df.select(id_col).join(out, id_col, "left").select(id_col, F.coalesce("repaired", F.lit("")).alias("repaired"))


def chunk(df: DataFrame, id_col: str, text: str, size: int, overlap: int) -> DataFrame:
    """Word windows of ``size`` words, stride ``size - overlap``; every word
    of the whole text lands in at least one chunk."""
    # split the whitespace-trimmed text (no empty tokens, no array lambda)
    body = F.regexp_replace(F.col(text), r"^\s+|\s+$", "")
    words = F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, r"\s+"))
    d = df.select(id_col, words.alias("_w"))
    stride = size - overlap
    n = F.size("_w")
    starts = F.sequence(F.lit(0), F.greatest(n - overlap - 1, F.lit(0)), F.lit(stride))
    c = d.select(id_col, "_w", F.posexplode(starts).alias("chunk_no", "_s"))
    c = c.where((F.col("_s") < n) | ((n == 0) & (F.col("_s") == 0)))
    piece = F.slice("_w", F.col("_s") + 1, F.lit(size))
    return c.select(id_col, F.col("chunk_no").cast("int").alias("chunk_no"), F.size(piece).alias("n_words"),
                    F.array_join(piece, " ").alias("text"))


CONDITION_PATTERN = r"([0-9]+(?:\.[0-9]+)?)\s*([A-Za-z%]+)"


def extract_conditions(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """Every number followed by a unit-like token becomes a record (position,
    value, unit), scanning the whole text."""
    vals = F.regexp_extract_all(F.col(text), F.lit(CONDITION_PATTERN), 1)
    units = F.regexp_extract_all(F.col(text), F.lit(CONDITION_PATTERN), 2)
    d = df.select(id_col, F.posexplode(F.arrays_zip(vals.alias("v"), units.alias("u"))).alias("pos", "_r"))
    return d.select(id_col, F.col("pos").cast("int").alias("pos"), F.col("_r.v").cast("double").alias("value"),
                    F.col("_r.u").alias("unit"))


# Fixed patterns of a condition record: a temperature, a time, the word after "in".
TEMPERATURE = r"(-?[0-9]+(?:\.[0-9]+)?)\s*(?:\u00b0\s*)?(C|K)\b"
DURATION = r"([0-9]+(?:\.[0-9]+)?)\s*(h|hr|hrs|hour|hours|min|minute|minutes)\b"
SOLVENT = r"\bin\s+([A-Za-z][A-Za-z0-9-]*)"
SENTENCE_END = r"[.!?]\s+|\n+"
NOTE_WORDS = 15


def condition_records(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """One record per sentence that names a temperature or a time: ``pos,
    temperature_c, time_h, solvent, note``. Kelvins and minutes are converted, the
    solvent is the word after "in" (NULL if there is none), the note the sentence's
    first ``NOTE_WORDS`` words. Sentences end at . ! ? before a space, or at a line end."""
    s = df.select(id_col, F.posexplode(F.split(F.col(text), SENTENCE_END)).alias("pos", "_s"))
    # a sentence is searched once per pattern; values and units come from the short matches
    found = s.select("*", F.regexp_extract("_s", TEMPERATURE, 0).alias("_t"), F.regexp_extract("_s", DURATION, 0).alias("_d"))
    found = found.where("_t <> '' or _d <> ''")
    part = lambda c, p, i: F.nullif(F.regexp_extract(c, p, i), F.lit(""))
    degrees, hours = part("_t", TEMPERATURE, 1).cast("double"), part("_d", DURATION, 1).cast("double")
    # array_remove is compiled; an array lambda would be interpreted per word
    words = F.array_remove(F.split("_s", r"\s+"), "")
    return found.select(id_col, F.col("pos").cast("int").alias("pos"),
                        F.when(part("_t", TEMPERATURE, 2) == "K", degrees - 273.15).otherwise(degrees).alias("temperature_c"),
                        F.when(F.startswith(part("_d", DURATION, 2), F.lit("min")), hours / 60.0).otherwise(hours).alias("time_h"),
                        part("_s", SOLVENT, 1).alias("solvent"), F.array_join(F.slice(words, 1, NOTE_WORDS), " ").alias("note"))


def normalise_entity(col: Column | str) -> Column:
    """Canonical form: lower case, runs of space/hyphen/underscore/dot -> one
    space, other punctuation removed, trimmed."""
    c = F.lower(_c(col))
    c = F.regexp_replace(c, r"[\s\-_.]+", " ")
    c = F.regexp_replace(c, r"[^\p{L}\p{N} ]", "")
    return F.trim(c)


def resolve_synonyms(df: DataFrame, col: str, synonyms: DataFrame) -> DataFrame:
    """Join normalised names to a (variant, canonical) synonym table; names
    without an entry keep their normalised form."""
    s = synonyms.select(normalise_entity(F.col(synonyms.columns[0])).alias("_n"),
                        F.col(synonyms.columns[1]).alias("_canon"))
    d = df.withColumn("_n", normalise_entity(col))
    return d.join(s, "_n", "left").select(*df.columns, F.coalesce("_canon", "_n").alias("entity"))


# Sentence classes by cue, checked in this order.
SENTENCE_RULES = [
    ("question", r"\?\s*$"),
    ("instruction", r"^(Please|Use|Add|Run|Try|Set|Do|Check)([\s,.;:!?]|$)"),
    ("listing", r",.*,.*,"),
]


def classify_sentences(df: DataFrame, id_cols: Sequence[str], text: str,
                       rules: Sequence[tuple[str, str]] = SENTENCE_RULES) -> DataFrame:
    """Split into sentences (after . ! ? or a newline) and give each the first
    matching class, 'statement' otherwise."""
    marked = F.regexp_replace(F.col(text), r"([.!?])\s+", "$1\u0001")
    sents = F.filter(F.transform(F.split(marked, "[\u0001\n]+"), lambda s: F.trim(s)), lambda s: s != "")
    d = df.select(*id_cols, F.posexplode(sents).alias("sent_no", "sentence"))
    cls = None
    for name, pat in rules:
        cls = F.when(F.col("sentence").rlike(pat), F.lit(name)) if cls is None else cls.when(F.col("sentence").rlike(pat), F.lit(name))
    return d.select(*id_cols, F.col("sent_no").cast("int").alias("sent_no"), cls.otherwise("statement").alias("class"),
                    F.length("sentence").alias("n_chars"))


def assemble_history(df: DataFrame, conv: str, turn: str, role: str, text: str, n: int) -> DataFrame:
    """Last ``n`` turns per conversation as an ordered list of (turn, role,
    content), as a chat model takes it (row_number filter -> partial group limit
    before the shuffle, so at most n rows per conversation are regathered)."""
    w = Window.partitionBy(conv).orderBy(F.col(turn).desc())
    last = df.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= n)
    return last.groupBy(conv).agg(
        F.array_sort(F.collect_list(F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("content")))).alias("history"),
        F.count(F.lit(1)).alias("n_turns"))


def follow_ups(df: DataFrame, conv: str, turn: str, role: str) -> DataFrame:
    """Each turn with the turn number of the previous user turn (follow-up)."""
    w = Window.partitionBy(conv).orderBy(turn).rowsBetween(Window.unboundedPreceding, -1)
    prev_user = F.max(F.when(F.col(role) == "user", F.col(turn))).over(w)
    return df.select(conv, turn, role, prev_user.alias("follows_user_turn"))


def json_kind(value: Column) -> Column:
    """'number', 'string', 'boolean', 'array', 'object' or 'null' of a VARIANT."""
    s = F.schema_of_variant(value)
    return (F.when(s.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), "number").when(s == "STRING", "string").when(s == "BOOLEAN", "boolean")
            .when(s.startswith("ARRAY"), "array").when(s.startswith("OBJECT"), "object").otherwise("null"))


def route_calls(calls: DataFrame, id_col: str, tool: str, args: str,
                specs: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Validate each call's JSON arguments against its tool's spec
    ({tool: {arg: kind}}, kinds as in ``json_kind``): unknown tool, missing or
    unexpected argument and wrong type are reported; ok calls get a normalised
    argument string ``name=value;...`` in spec order. Arguments are parsed once to
    VARIANT, so ``{"k": "5"}`` is a string and no number."""
    v = F.try_parse_json(F.col(args))
    d = calls.select(id_col, tool, v.alias("_v")).withColumn("_o", F.schema_of_variant("_v").startswith("OBJECT"))
    d = d.withColumn("_k", F.when(F.col("_o"), F.json_object_keys(F.to_json("_v"))))
    at = lambda a, kind: F.try_variant_get("_v", f"$['{a}']", kind)
    err = norm = None
    for t, spec in specs.items():
        names = F.array(*[F.lit(a) for a in spec])
        missing, extra = F.array_except(names, "_k"), F.array_sort(F.array_except("_k", names))
        wrong = F.lit(False)
        for a, kind in spec.items():
            wrong = wrong | (json_kind(at(a, "variant")) != kind)
        e = (F.when(~F.coalesce("_o", F.lit(False)), F.lit("bad json"))
             .when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ",")))
             .when(F.size(extra) > 0, F.concat(F.lit("unexpected: "), F.array_join(extra, ",")))
             .when(wrong, F.lit("wrong type")))
        nv = F.concat_ws(";", *[F.concat(F.lit(f"{a}="), at(a, "string")) for a in spec])
        err = F.when(F.col(tool) == t, e) if err is None else err.when(F.col(tool) == t, e)
        norm = F.when(F.col(tool) == t, nv) if norm is None else norm.when(F.col(tool) == t, nv)
    error = F.when(F.col(tool).isNull() | ~F.col(tool).isin(list(specs)), F.lit("unknown tool")).otherwise(err)
    return d.select(id_col, tool, error.isNull().alias("ok"), error.alias("error"),
                    F.when(error.isNull(), norm).alias("call"))


def collect_results(routed: DataFrame, turn: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per call with its place in its turn (from 1, in ``order``) and the
    content that goes back: the call's result, or its error. The place is a running
    count over ranges, so a turn with very many calls is no single task's work."""
    r = running(routed.withColumn("_one", F.lit(1)), list(order), {"place": ("count", "_one")}, list(turn), block=RANGE)
    content = F.when(F.col("ok"), F.col("call")).otherwise(F.concat(F.lit("error: "), F.col("error")))
    return r.drop("_one").withColumn("content", content)


# 20 page categories and the pattern that flags each (searched
# in lower-cased page HTML).
PAGE_CATEGORIES = [
    ("navigation", r"<nav"), ("list", r"<ul"), ("link", r"<a "), ("script", r"<script"),
    ("style", r"<style"), ("title", r"<title"), ("meta", r"<meta"), ("heading", r"<h1"),
    ("paragraph", r"<p>"), ("bold", r"<b>"), ("break", r"<br"), ("article", r"<article"),
    ("advert", r"class=\"ad\""), ("comment", r"<!--"), ("entity", r"&amp;"), ("lang_en", r"lang=\"en\""),
    ("lang_fr", r"lang=\"fr\""), ("lang_de", r"lang=\"de\""), ("lang_es", r"lang=\"es\""), ("junk", r"%%%"),
]


def page_flags(df: DataFrame, id_cols: Sequence[str], html: str,
               categories: Sequence[tuple[str, str]] = PAGE_CATEGORIES) -> DataFrame:
    """One 'Y'/'N' column per category."""
    h = F.lower(F.col(html))
    return df.select(*id_cols, *[F.when(h.rlike(p), "Y").otherwise("N").alias(c) for c, p in categories])


def page_matrix(flags: DataFrame, doc: str, page: str, categories: Sequence[str]) -> DataFrame:
    """Long category x document matrix: the ordered page list ('page 1, page
    3') of every (category, document) with at least one flagged page."""
    long = flags.unpivot([doc, page], list(categories), "category", "flag").where(F.col("flag") == "Y")
    g = long.groupBy("category", doc).agg(F.array_sort(F.collect_list(page)).alias("_p"))
    return g.select("category", doc, F.array_join(F.transform("_p", lambda p: F.concat(F.lit("page "), p.cast("string"))),
                                                  ", ").alias("pages"))


def pages_for(flags: DataFrame, category: str, order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` pages flagged for a category (a top-n report)."""
    return flags.where(F.col(category) == "Y").orderBy(*order).limit(n)
