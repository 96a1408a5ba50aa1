"""Text, JSON and reply-parsing functions used inside table jobs.

Each works on one row's own text with Spark string, regex, JSON and
higher-order array functions, so it runs in parallel over any number of
rows and never moves a text anywhere but its own task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vialflow.session import ensure_checkpoint_dir


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def label_from_name(name: Column | str, positive: str, negatives: Sequence[str]) -> Column:
    """1/0 label from a file name or URL part: the positive prefix is checked
    first, then the negative prefixes, the negative substrings and the positive
    substring; NULL when nothing matches."""
    f = F.lower(_c(name))
    neg_prefix = None
    for n in negatives:
        c = f.startswith(f"{n}_")
        neg_prefix = c if neg_prefix is None else (neg_prefix | c)
    neg_sub = None
    for n in negatives:
        c = f.contains(n)
        neg_sub = c if neg_sub is None else (neg_sub | c)
    return (F.when(f.startswith(f"{positive}_"), F.lit(1))
            .when(neg_prefix, F.lit(0)).when(neg_sub, F.lit(0))
            .when(f.contains(positive), F.lit(1)))


# Reserved token ids of the character vocabulary.
PAD_ID = 0
UNK_ID = 1
N_RESERVED = 2


def chars(text: Column | str) -> Column:
    """Array of the characters of a text (whole text)."""
    t = _c(text)
    return F.filter(F.split(t, ""), lambda ch: ch != "")


def char_vocab(df: DataFrame, col: str) -> DataFrame:
    """Distinct characters with ids from 2 (0 = pad, 1 = unknown), in
    character order. Each text is first reduced to its own distinct
    characters (compiled ``array_distinct``), then a partial aggregate builds
    the alphabet; the final numbering runs over the (small) alphabet only."""
    ch = (df.select(F.explode(F.array_distinct(F.split(F.col(col), ""))).alias("char"))
          .where(F.col("char") != "").distinct())
    w = Window.orderBy("char")
    return ch.select("char", (F.row_number().over(w) + F.lit(N_RESERVED - 1)).cast("int").alias("id"))


def tokenize(df: DataFrame, col: str, vocab: DataFrame, max_len: int, out: str = "ids") -> DataFrame:
    """Characters -> ids (unknown -> 1), truncated to ``max_len`` and padded
    with 0. The vocabulary is one map value attached to every row by a
    one-row broadcast join (an alphabet, bounded)."""
    vmap = vocab.agg(F.map_from_entries(F.collect_list(F.struct("char", "id"))).alias("_vocab"))
    j = df.join(F.broadcast(vmap), how="cross")
    ids = F.transform(chars(col), lambda ch: F.coalesce(F.try_element_at(F.col("_vocab"), ch), F.lit(UNK_ID)))
    cut = F.slice(ids, 1, max_len)
    padded = F.concat(cut, F.array_repeat(F.lit(PAD_ID), F.greatest(F.lit(0), F.lit(max_len) - F.size(cut))))
    return j.select(*df.columns, padded.alias(out))


def positional_encoding(positions: DataFrame, pos_col: str, d: int) -> DataFrame:
    """Sinusoidal table for the given positions: (pos, dim, value) with
    sin on even dims and cos on odd dims, frequency 10000^(-2i/d)."""
    dims = positions.sparkSession.range(d).select(F.col("id").cast("int").alias("dim"))
    j = positions.select(F.col(pos_col).alias("pos")).distinct().crossJoin(F.broadcast(dims))
    i2 = (F.floor(F.col("dim") / 2) * 2).cast("double")
    angle = F.col("pos") / F.pow(F.lit(10000.0), i2 / F.lit(float(d)))
    return j.select("pos", "dim", F.when(F.col("dim") % 2 == 0, F.sin(angle)).otherwise(F.cos(angle)).alias("value"))


def parse_suggestion(text: Column | str, key: str = "k") -> Column:
    """Number from a reply: the JSON field ``key`` when the text is JSON,
    otherwise the first number in the text."""
    t = _c(text)
    js = F.from_json(t, f"`{key}` double", {"mode": "PERMISSIVE"})[key]
    first = F.regexp_extract(t, r"(-?[0-9]+(\.[0-9]+)?)", 1)
    return F.coalesce(js, F.when(first != "", first.cast("double")))


def strip_fences(text: Column | str) -> Column:
    """Remove a leading ```lang line and a trailing ``` fence."""
    t = F.regexp_replace(_c(text), r"^\s*```[A-Za-z0-9_-]*[ \t]*\r?\n?", "")
    return F.regexp_replace(t, r"\r?\n?```\s*$", "")


def nonempty_lines(text: Column | str) -> Column:
    return F.filter(F.transform(F.split(_c(text), r"\r?\n"), lambda s: F.trim(s)), lambda s: s != "")


def parse_label(text: Column | str) -> Column:
    """struct(label, rationale) from a model reply.

    label: the first line whose first word is Y, N, YES or NO (any case)
    gives 'Y' or 'N'; rationale: text after ':' of the first line starting
    with 'rational', else the second non-empty line, else ''.
    """
    lines = nonempty_lines(text)
    first_word = lambda s: F.upper(F.regexp_extract(s, r"^([A-Za-z]+)", 1))
    lab_lines = F.filter(lines, lambda s: first_word(s).isin("Y", "N", "YES", "NO"))
    label = F.when(F.size(lab_lines) > 0, F.substring(first_word(F.element_at(lab_lines, 1)), 1, 1))
    rat_lines = F.filter(lines, lambda s: F.lower(s).startswith("rational"))
    rat = F.when(F.size(rat_lines) > 0,
                 F.trim(F.regexp_extract(F.element_at(rat_lines, 1), r"^[^:]*:(.*)$", 1)))
    fallback = F.when(F.size(lines) >= 2, F.element_at(lines, 2))
    rationale = F.coalesce(F.when(rat != "", rat), fallback, F.lit(""))
    return F.struct(F.coalesce(label, F.lit("")).alias("label"), rationale.alias("rationale"))


def markdown_table(df: DataFrame, id_col: str, col: str) -> DataFrame:
    """Markdown table text -> long rows (id, row_no, column, value).

    Edge pipes are stripped, only separator lines (pipes, dashes, colons,
    spaces) are dropped, the first remaining line is the header. Lines with
    another number of cells than the header are skipped, and text with fewer
    than two columns in its header gives no rows.
    """
    lines = F.filter(nonempty_lines(col), lambda s: ~s.rlike(r"^[\s|:\-]+$") & s.contains("|"))
    cells = F.transform(lines, lambda s: F.transform(
        F.split(F.regexp_replace(F.regexp_replace(s, r"^\s*\|", ""), r"\|\s*$", ""), r"\|"),
        lambda c: F.trim(c)))
    d = df.select(id_col, cells.alias("_cells")).where(F.size("_cells") >= 2)
    d = d.where(F.size(F.element_at("_cells", 1)) >= 2)
    rows = d.select(id_col, F.element_at("_cells", 1).alias("_hdr"),
                    F.posexplode(F.slice("_cells", 2, 1 << 30)).alias("row_no", "_vals"))
    out = rows.where(F.size("_vals") == F.size("_hdr")).select(id_col, (F.col("row_no") + 1).cast("int").alias("row_no"),
                      F.posexplode(F.arrays_zip(F.col("_hdr").alias("h"), F.col("_vals").alias("v"))).alias("_i", "_hv"))
    return out.where(F.col("_hv.h").isNotNull()).select(
        id_col, "row_no", F.col("_hv.h").alias("column"), F.col("_hv.v").alias("value"))


def json_rows(df: DataFrame, id_col: str, col: str, ddl: str) -> DataFrame:
    """JSON array of objects -> one typed row per element; text that is not
    a JSON array of objects gives no rows."""
    arr = F.from_json(_c(col), f"array<struct<{ddl}>>", {"mode": "PERMISSIVE"})
    return (df.select(id_col, F.posexplode(arr).alias("pos", "_r"))
            .select(id_col, F.col("pos").cast("int").alias("pos"), "_r.*"))


def enforce_schema(df: DataFrame, col: str, ddl: str, required: Sequence[str]) -> DataFrame:
    """Parse a JSON object with a fixed DDL (PERMISSIVE: wrong types become
    NULL), then flag rows that are not JSON objects or miss a required field."""
    parsed = F.from_json(_c(col), ddl, {"mode": "PERMISSIVE"})
    is_obj = F.coalesce(F.trim(_c(col)).startswith("{") & F.trim(_c(col)).endswith("}"), F.lit(False))
    d = df.withColumn("_p", F.when(is_obj, parsed))
    missing = F.filter(F.array(*[F.when(F.col(f"_p.{r}").isNull(), F.lit(r)) for r in required]),
                       lambda x: x.isNotNull())
    err = (F.when(~is_obj | F.col("_p").isNull(), F.lit("not a JSON object"))
           .when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ","))))
    fields = [f.split()[0].strip("`") for f in ddl.split(",")]
    return d.select(*df.columns, *[F.col(f"_p.{f}").alias(f) for f in fields],
                    err.isNull().alias("ok"), err.alias("error"))


def flags_with_default(text: Column | str, keys: Sequence[str], default: str = "N") -> list[Column]:
    """One column per key: 'Y' or 'N' from a JSON object of flags (case and
    spaces ignored); anything else, or a missing key, gives ``default``."""
    m = F.from_json(_c(text), "map<string,string>", {"mode": "PERMISSIVE"})
    out = []
    for k in keys:
        v = F.upper(F.trim(F.try_element_at(m, F.lit(k))))
        out.append(F.when(v.isin("Y", "N"), v).otherwise(F.lit(default)).alias(k))
    return out


def render_prompt(template: str, fields: dict[str, Column | str]) -> Column:
    """Fill ``{name}`` slots of a template with column values (NULL -> '')."""
    import re
    parts = []
    pos = 0
    for m in re.finditer(r"\{([A-Za-z_][A-Za-z0-9_]*)\}", template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(F.coalesce(_c(fields[m.group(1)]).cast("string"), F.lit("")))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


TWO_PI = 2 * math.pi


def parse_questions(df: DataFrame, id_cols: Sequence[str], text: str, keys: Sequence[str]) -> DataFrame:
    """Question-block replies -> one row per reply with a flag and a reason
    per question key.

    Lines ``Q<n>: <answer>`` open question n; a following ``Rational(e): ...``
    line is the reason of the most recent question. Missing questions give
    '' for both. Lines are exploded with their position and the running
    question number is the last one seen (a window inside one reply).
    """
    lines = df.select(*id_cols, F.posexplode(F.split(F.col(text), r"\r?\n")).alias("_pos", "_line"))
    lines = lines.withColumn("_line", F.trim("_line"))
    qn = F.regexp_extract("_line", r"^Q([0-9]+)\s*:", 1)
    lines = lines.withColumn("_q", F.when(qn != "", F.concat(F.lit("Q"), qn)))
    w = Window.partitionBy(*id_cols).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("_cur", F.last("_q", ignorenulls=True).over(w))
    ans = F.when(F.col("_q").isNotNull(), F.upper(F.trim(F.regexp_extract("_line", r"^Q[0-9]+\s*:\s*(.*)$", 1))))
    why = F.when(F.col("_q").isNull() & F.lower("_line").rlike(r"^rationale?\s*:"),
                 F.trim(F.regexp_extract("_line", r"^[^:]*:(.*)$", 1)))
    # earliest answer / reason line of each question (deterministic)
    per = lines.groupBy(*id_cols, F.col("_cur").alias("q")).agg(
        F.min(F.when(ans.isNotNull(), F.struct(F.col("_pos"), ans.alias("v"))))["v"].alias("flag"),
        F.min(F.when(why.isNotNull(), F.struct(F.col("_pos"), why.alias("v"))))["v"].alias("reason"))
    per = per.where(F.col("q").isin(list(keys)))
    wide = per.groupBy(*id_cols).pivot("q", list(keys)).agg(F.first("flag").alias("flag"), F.first("reason").alias("reason"))
    base = df.select(*id_cols).distinct()
    j = base.join(wide, list(id_cols), "left")
    out = []
    for k in keys:
        out += [F.coalesce(F.col(f"{k}_flag"), F.lit("")).alias(f"{k}_flag"),
                F.coalesce(F.col(f"{k}_reason"), F.lit("")).alias(f"{k}_reason")]
    return j.select(*id_cols, *out)


PROPS_DDL = "array<struct<label:string,value:struct<sval:string,fval:double,ival:bigint>>>"


def props_to_fields(df: DataFrame, id_col: str, text: str, labels: Sequence[str], n: int | None = None) -> DataFrame:
    """Label/value property arrays whose value is one of several typed
    alternatives (string, float, int) -> one text column per label. The first
    value of a label wins; ``n`` keeps only the first n records."""
    arr = F.from_json(F.col(text), PROPS_DDL, {"mode": "PERMISSIVE"})
    if n is not None:
        arr = F.slice(arr, 1, n)
    e = df.select(id_col, F.posexplode(arr).alias("_i", "_p"))
    v = F.coalesce(F.col("_p.value.sval"), F.col("_p.value.fval").cast("string"), F.col("_p.value.ival").cast("string"))
    long = e.select(id_col, "_i", F.col("_p.label").alias("label"), v.alias("value"))
    wide = long.groupBy(id_col).pivot("label", list(labels)).agg(F.min_by("value", "_i"))
    return df.select(id_col).join(wide, id_col, "left").select(id_col, *[F.col(c) for c in labels])


def _parts(section: Column, path: str) -> Column:
    """An array member of a VARIANT section, empty where it is absent."""
    return F.coalesce(F.try_variant_get(section, path, "array<variant>"), F.array().cast("array<variant>"))


def _own_lines(section: Column) -> Column:
    """Non-empty trimmed strings of one section's Information, in order."""
    strings = F.flatten(F.transform(_parts(section, "$.Information"), lambda i: F.transform(
        _parts(i, "$.Value.StringWithMarkup"), lambda x: F.trim(F.try_variant_get(x, "$.String", "string")))))
    return F.filter(strings, lambda t: t.isNotNull() & (t != ""))


def _title(section: Column) -> Column:
    heading = F.try_variant_get(section, "$.TOCHeading", "string")
    return F.coalesce(F.when(heading != "", heading), F.try_variant_get(section, "$.Title", "string"), F.lit(""))


def find_sections(df: DataFrame, id_col: str, text: str, keyword: str, max_lines: int = 12) -> DataFrame:
    """Sections of nested records, at any depth, whose title contains
    ``keyword`` (case-insensitive): ``order``, ``title``, ``path``
    (' > A > B'), the first ``max_lines`` strings of the section and its
    subsections in document order, and ``n_lines``, how many there are.

    The tree is unrolled one level per round, all records at once, until no
    section has children; a hit then gathers the lines of the sections whose
    place starts with its own. A record that is no JSON has no sections.
    """
    ensure_checkpoint_dir(df.sparkSession)

    def nodes(parents, sections, place, path):
        d = parents.select(id_col, place.alias("_up"), path.alias("_path"), F.posexplode(sections).alias("_i", "_s"))
        return d.select(id_col, F.concat("_up", F.array("_i")).alias("_place"),
                        F.concat("_path", F.lit(" > "), _title(F.col("_s"))).alias("path"), "_s").checkpoint()

    top = df.select(id_col, F.try_parse_json(F.col(text)).alias("_v"))
    level = nodes(top, _parts(F.col("_v"), "$.Record.Section"), F.array().cast("array<int>"), F.lit(""))
    found = []
    while not level.isEmpty():
        found.append(level.select(id_col, "_place", "path", _title(F.col("_s")).alias("title"),
                                  _own_lines(F.col("_s")).alias("_lines")))
        level = nodes(level, _parts(F.col("_s"), "$.Section"), F.col("_place"), F.col("path"))
    if not found:
        found.append(level.select(id_col, "_place", "path", F.lit("").alias("title"), F.array().cast("array<string>").alias("_lines")))
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    hits = every.where(F.lower("title").contains(keyword.lower())).select(id_col, "_place", "path", "title")
    parts = every.select(id_col, F.explode(F.transform(F.sequence(F.lit(1), F.size("_place")),
                                                       lambda k: F.slice("_place", 1, k))).alias("_hit"), "_place", "_lines")
    text_of = hits.join(parts.withColumnRenamed("_place", "_at"),
                        (hits[id_col] == parts[id_col]) & (F.col("_place") == F.col("_hit"))).groupBy(
        hits[id_col], "_place", "path", "title").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_lines"))), lambda x: x["_lines"])).alias("_all"))
    return text_of.select(id_col, F.array_join(F.transform("_place", lambda x: x.cast("string")), ".").alias("order"),
                          "title", "path", F.array_join(F.slice("_all", 1, max_lines), "\n").alias("text"),
                          F.size("_all").alias("n_lines"))
