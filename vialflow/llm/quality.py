"""Quality rules with risk-controlled cutoffs (JVM operators only).

Each rule scores a document (higher is worse) and rejects it above a cutoff.
Cutoffs are not tuned by hand: on labelled documents an exact binomial test
decides which cutoffs reject at most a share ``alpha`` of the good documents
of a stratum, at confidence ``1 - delta`` over all strata and rules together.

* Each rule may spend ``alpha / number of rules`` (a union bound: together the
  rules reject at most ``alpha``).
* Each (stratum, rule) chain is tested at ``delta / (strata * rules)``
  (Bonferroni). Within a chain the cutoffs are tested from lenient to strict
  and testing stops at the first failure, so the chain needs no further
  correction (fixed-sequence testing).
* Among the cutoffs that hold, the one with the best margin (share of bad
  documents caught minus share of good ones) is used; no margin, no rule.

The p-value of "k of n good documents rejected" is P(Bin(n, a) <= k), summed
from its largest term downwards; terms beyond ``_TAIL`` are replaced by their
geometric bound, which can only make the test stricter.

Defined cases: NULL or empty text has no words (all counts 0, base_failed);
NULL strata form one stratum; a document with several label rows counts only
if they agree and are not NULL; a stratum without labels, or with too few,
gets no cutoffs, and only the base rules apply there; repeated rows are judged
one by one; other columns of the input are kept unless they carry the name of
an output column, which then replaces them; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vialflow.llm.common import GAP, GAP_CLASS, materialise, prepare, read, register, text_of

#: Rule -> (numerator, denominator) among the measures below.
RULES = {
    "symbols": ("n_symbols", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "capitals": ("n_capitals", "word_chars"),
}
#: Cutoffs from lenient to strict, the same for every rule, fixed beforehand.
CUTOFFS = (1.0, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1)
ALPHA = 0.05
DELTA = 0.05
_TAIL = 4000
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


def measure(docs: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with the measures of each whole text, written and read back.

    One map-only pass; written so that neither calibration nor a filter on
    the measures repeats it. ``keep_text=False`` leaves the text out.
    Repeated 3-word windows are found by sorting the window hashes (64 bit) of
    one document and comparing neighbours, so the work is n log n in its words.
    """
    text = text_of(text_col)
    d = docs.drop(*MEASURES).withColumn("_q_words", F.array_remove(F.split(text, GAP), ""))
    w = F.col("_q_words")
    d = d.withColumns({
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long"),
        "n_capitals": F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long"),
        "_q_lines": F.filter(F.split(text, "\n"), lambda s: s.rlike(f"[^{GAP_CLASS}]")),
        "_q_hash": F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
                               lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))),
    }).drop("_q_words")
    h, lines = F.col("_q_hash"), F.col("_q_lines")
    d = d.withColumns({
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        # only documents with a repeated window need the sorted list
        "_q_sorted": F.when(F.size(F.array_distinct(h)) < F.size(h),
                            F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))),
    }).drop("_q_hash", "_q_lines")
    s = F.col("_q_sorted")
    again = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
    d = d.withColumn("_q_at", F.sort_array(F.transform(again, lambda x: x["i"]))).drop("_q_sorted")
    at = F.col("_q_at")
    covered = F.aggregate(F.transform(at, lambda p, i: F.coalesce(F.least(F.get(at, i + 1) - p, F.lit(3)), F.lit(3))),
                          F.lit(0), lambda a, x: a + x)
    d = d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_q_at")
    return materialise(d if keep_text else d.drop(text_col), "quality-measures")


def _score(rule: str) -> Column:
    num, den = RULES[rule]
    return F.when(F.col(den) > 0, F.col(num).cast("double") / F.col(den)).otherwise(F.lit(0.0))


def base_failed() -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _ln_gamma(x: Column) -> Column:
    """ln Gamma for x > 0: Stirling's series at x + 16, stepped back."""
    y = x + 16
    series = ((y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi)
              + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, F.lit(5.0))))
    back = F.lit(0.0)
    for i in range(16):
        back = back + F.log(x + i)
    return series - back


def binomial_lower_tail(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k) for k below the mean n * p, otherwise 1.0 (no evidence)."""
    nd, kd = n.cast("double"), k.cast("double")
    top = F.exp(_ln_gamma(nd + 1) - _ln_gamma(kd + 1) - _ln_gamma(nd - kd + 1)
                + kd * math.log(p) + (nd - kd) * math.log1p(-p))
    odds = (1 - p) / p

    def step(acc, j):
        term = acc["term"] * (kd - j + 1) * odds / (nd - kd + j)
        return F.struct((acc["sum"] + term).alias("sum"), term.alias("term"))

    def rest(acc):
        ratio = (kd - _TAIL) * odds / (nd - kd + _TAIL + 1)
        return acc["sum"] + F.when(kd > _TAIL, acc["term"] * ratio / (1 - ratio)).otherwise(F.lit(0.0))

    total = F.aggregate(F.when(kd > 0, F.sequence(F.lit(1), F.least(k, F.lit(_TAIL)).cast("int")))
                        .otherwise(F.array().cast("array<int>")),
                        F.struct(top.alias("sum"), top.alias("term")), step, rest)
    return F.when((nd > 0) & (kd < nd * p), F.least(total, F.lit(1.0))).otherwise(F.lit(1.0))


def calibrate(measured: DataFrame, labels: DataFrame, stratum_col: str = "lang", id_col: str = "doc_id",
              label_col: str = "quality", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Cutoffs per stratum: columns ``stratum`` and one nullable cutoff per rule.

    One aggregate pass over the labelled documents that pass the base rules
    gives the counts of every (stratum, rule, cutoff); what follows works on a
    few rows per stratum.
    """
    known = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
             .groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_z"), F.count("_y").alias("_n"),
                                 F.count(F.lit(1)).alias("_m"))
             .where((F.col("_y") == F.col("_z")) & (F.col("_n") == F.col("_m"))).select("_id", "_y"))
    d = (measured.where(~base_failed())
         .select(F.col(id_col).alias("_id"), F.col(stratum_col).alias("stratum"), *[_score(r).alias(r) for r in RULES])
         .join(known, "_id"))
    good, bad = F.col("_y") == 1, F.col("_y") == 0
    counts = [F.count(F.when(good, 1)).alias("n_good"), F.count(F.when(bad, 1)).alias("n_bad")]
    for r in RULES:
        for i, c in enumerate(CUTOFFS):
            counts += [F.count(F.when(good & (F.col(r) > c), 1)).alias(f"g_{r}_{i}"),
                       F.count(F.when(bad & (F.col(r) > c), 1)).alias(f"b_{r}_{i}")]
    per = d.groupBy("stratum").agg(*counts).where(F.col("n_good") > 0)
    strata = per.agg(F.count(F.lit(1)).alias("n")).scalar()
    tests = per.select("stratum", "n_good", "n_bad", F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(i).alias("step"), F.lit(c).alias("cutoff"),
                 F.col(f"g_{r}_{i}").alias("good"), F.col(f"b_{r}_{i}").alias("bad"))
        for r in RULES for i, c in enumerate(CUTOFFS)])).alias("t")).select("stratum", "n_good", "n_bad", "t.*")
    tests = tests.withColumn("p_value", binomial_lower_tail(F.col("n_good"), F.col("good"), alpha / len(RULES)))
    chain = Window.partitionBy("stratum", "rule").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    tests = tests.withColumn("holds", F.max("p_value").over(chain) <= F.lit(delta) / (strata * len(RULES)))
    margin = (F.when(F.col("n_bad") > 0, F.col("bad") / F.col("n_bad")).otherwise(F.lit(0.0))
              - F.col("good") / F.col("n_good"))
    best = (tests.withColumn("margin", margin).where(F.col("holds") & (F.col("margin") > 0))
            .groupBy("stratum").pivot("rule", list(RULES))
            .agg(F.max_by("cutoff", F.struct("margin", -F.col("step")))))
    return best.select("stratum", *[F.col(r).alias(f"cut_{r}") for r in RULES])


def judge(measured: DataFrame, cutoffs: DataFrame, stratum_col: str = "lang") -> DataFrame:
    """``measured`` with ``base_failed``, ``failed_rules`` and ``kept``."""
    c = cutoffs.withColumnRenamed("stratum", "_q_stratum")
    d = measured.drop("base_failed", "failed_rules", "kept").join(
        c, F.col(stratum_col).eqNullSafe(F.col("_q_stratum")), "left")
    failed = [F.coalesce(_score(r) > F.col(f"cut_{r}"), F.lit(False)) for r in RULES]
    d = d.withColumn("base_failed", base_failed())
    d = d.withColumn("failed_rules", F.concat_ws(",", *[F.when(f, F.lit(r)) for r, f in zip(RULES, failed)]))
    return (d.withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))
            .drop("_q_stratum", *[f"cut_{r}" for r in RULES]))


def keep_good(docs: DataFrame, labels: DataFrame, stratum_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns only."""
    names = {c: f"_k{i}" for i, c in enumerate(docs.columns)
             if c in (*MEASURES, "base_failed", "failed_rules", "kept")}
    d = measure(docs.withColumns({new: F.col(c) for c, new in names.items()}))
    kept = judge(d, calibrate(d, labels, stratum_col), stratum_col).where("kept")
    return kept.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])


def _sql() -> str:
    scored = ", ".join(f"case when {den} > 0 then {num}::double / {den} else 0 end as s_{r}"
                       for r, (num, den) in RULES.items())
    cuts = ", ".join(f"({i}, {c}::double)" for i, c in enumerate(CUTOFFS))
    a = ALPHA / len(RULES)
    long = " union all ".join(f"select doc_id, lang, base_failed, '{r}' as rule, s_{r} as score from scored" for r in RULES)
    order = "case rule " + " ".join(f"when '{r}' then {i}" for i, r in enumerate(RULES)) + " end"
    return rf"""
with words as (
  select doc_id, lang, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '{WORD_SQL}') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '[^{GAP_CLASS}]')) as lines
  from documents),
spans as (
  select doc_id, unnest(w) as a, generate_subscripts(w, 1) as i from words),
three as (
  select doc_id, i, a || ' ' || lead(a) over p || ' ' || lead(a, 2) over p as t from spans
  window p as (partition by doc_id order by i)),
twice as (
  select doc_id, i from three where t is not null
  qualify count(*) over (partition by doc_id, t) > 1),
covered as (
  select doc_id, count(distinct i + o.k) as n from twice, (values (0), (1), (2)) o(k) group by doc_id),
measured as (
  select words.doc_id, lang, len(w)::bigint as n_words, coalesce(length(array_to_string(w, '')), 0)::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(covered.n, 0)::bigint as n_repeat_words, len(lines)::bigint as n_lines,
    length(regexp_replace(text, '[^A-Z]+', '', 'g'))::bigint as n_capitals
  from words left join covered on words.doc_id is not distinct from covered.doc_id),
scored as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, {scored} from measured),
rules as ({long}),
known as (
  select doc_id, min(quality) as y from labels group by doc_id
  having min(quality) = max(quality) and count(quality) = count(*)),
counts as (
  select lang, rule, step, cutoff, count(*) filter (y = 1) as n_good, count(*) filter (y = 0) as n_bad,
    count(*) filter (y = 1 and score > cutoff) as good, count(*) filter (y = 0 and score > cutoff) as bad
  from rules join known using (doc_id), (values {cuts}) c(step, cutoff)
  where not base_failed group by all having count(*) filter (y = 1) > 0),
tails as (
  select lang, rule, step, sum(exp(lgamma(n_good + 1) - lgamma(j + 1) - lgamma(n_good - j + 1)
    + j * ln({a}) + (n_good - j) * ln(1 - {a}))) as tail
  from (select *, unnest(range(0, good + 1)) as j from counts) group by all),
tests as (
  select counts.*, max(case when good < n_good * {a} then least(tail, 1) else 1 end)
      over (partition by counts.lang, counts.rule order by counts.step) as worst,
    case when n_bad > 0 then bad::double / n_bad else 0 end - good::double / n_good as margin
  from counts join tails on counts.lang is not distinct from tails.lang
    and counts.rule = tails.rule and counts.step = tails.step),
best as (
  select lang, rule, cutoff from tests
  where worst <= {DELTA}::double / ((select count(distinct coalesce(lang, '?null')) from counts) * {len(RULES)}) and margin > 0
  qualify row_number() over (partition by lang, rule order by margin desc, step) = 1),
failed as (
  select doc_id, string_agg(rules.rule, ',' order by {order.replace('rule', 'rules.rule', 1)}) as failed_rules
  from rules join best on rules.lang is not distinct from best.lang and rules.rule = best.rule
  where score > cutoff group by doc_id)
select scored.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and failed.doc_id is null as kept, coalesce(failed_rules, '') as failed_rules
from scored left join failed on scored.doc_id is not distinct from failed.doc_id
"""


WORD_SQL = f"[^{GAP_CLASS}]+"


@register("op1_quality_rules", _sql())
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every document and the verdict of the calibrated rules.

    The small table of measures is written once and serves both the
    calibration and the verdict, so each text is read a single time.
    """
    prepare(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    measured = measure(docs, keep_text=False)
    cutoffs = calibrate(measured, read(spark, sf_dir, "labels"))
    return judge(measured, cutoffs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "failed_rules")
