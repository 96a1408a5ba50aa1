"""Mixing sources to target weights by pivotal dependent rounding.

A source with target share t and size s should be taken t / s times. Whole
copies are given to every document; the fractional rest is a copy probability,
equal for all documents of the source, and is rounded to 0 or 1 by pivotal
steps: two fractional documents are paired and copy mass (measured in words)
moves from one to the other, at random but keeping both expectations, until
one of them is integral; the other goes on. Every step conserves words, so a
source's taken words miss its target by rounding alone.

Distribution: documents are dealt into small groups of one source by a hash,
each group leaves at most one fractional document, and these residuals are
combined by the same step in a reduction tree until one per source is left.
That one is taken in part: its first words, as many as its mass (or it is
rounded at random, where only whole documents are wanted). A source with a third of all rows is just more
groups; no task ever holds more than about ``GROUP`` documents.

Randomness comes from hashes of the seed and the documents' own values, never
from positions, so reruns agree at any partitioning.

Defined cases: NULL or empty text has size 0 and is taken 0 words (its copies
follow the same rounding); NULL source is a source of its own, ordered last;
repeated rows are documents of their own; a source of size 0 has target 0; an
empty table gives no rows; other columns of the input are kept unless they
carry the name of an output column.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vialflow.llm.common import WORD, materialise, prepare, read, register, text_of

WEIGHTS = (1.0, 2.0, 3.0)
MAX_COPIES = 3
#: Documents per group of the reduction tree (the fan-in of one step).
GROUP = 2048
_EPS = 1e-9


def n_words(text_col: str = "text") -> Column:
    """Number of words of the whole text; NULL counts 0."""
    return F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long")


def targets(sized: DataFrame, source_col: str = "source", weights: tuple = WEIGHTS,
            max_copies: int = MAX_COPIES) -> DataFrame:
    """One row per source: ``source``, ``n_docs``, ``source_size``, ``target``.

    Sources in code point order (NULL last) weigh ``weights`` in turn. All
    sizes are shared by weight; where a share exceeds ``max_copies`` times the
    source's size it stops there and the excess is shared among the others.
    That water level is found in one ordered pass over the sources: a source
    is capped if its cap per weight is at most the level of those above it.
    """
    per = sized.groupBy(F.col(source_col).alias("source")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                (turn % len(weights) + 1).cast("int")))
    cap = F.col("source_size") * max_copies
    by_level = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    per = per.withColumns({
        "_left": F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0)),
        "_weights": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
    })
    share = F.col("_left") / F.col("_weights")
    per = per.withColumn("_capped", cap <= F.col("weight") * share)
    # the level is the share at the first source that is not capped
    level = F.min(F.when(~F.col("_capped"), F.struct(cap / F.col("weight"), share.alias("share")))).over(everything)
    target = F.when(F.col("_capped") | level.isNull(), cap.cast("double")).otherwise(F.col("weight") * level["share"])
    return per.select("source", "n_docs", "source_size", target.alias("target"))


def _pivot(rows: pa.Table) -> pa.Table:
    """Pivotal steps through one group, in the order of the documents' hashes.

    ``p`` holds copy probabilities. With sizes a and b, mass m moves as +m/a
    and -m/b, so a*p + b*q stays what it is; the direction is drawn so that
    both expectations stay too. Documents of size 0 carry no mass and are
    rounded on their own.
    """
    rows = rows.sort_by([("_draw", "ascending"), ("_key", "ascending")])
    p, size, draw = (rows.column(c).to_numpy().astype(np.float64, copy=True) for c in ("p", "size", "_draw"))
    open_at = -1
    for i in range(len(p)):
        if not _EPS < p[i] < 1 - _EPS:
            p[i] = round(p[i])
            continue
        if size[i] <= 0:
            p[i] = 1.0 if draw[i] < p[i] else 0.0
            continue
        if open_at < 0:
            open_at = i
            continue
        j = open_at
        up = min((1 - p[j]) * size[j], p[i] * size[i])      # words that may move from i to j
        down = min(p[j] * size[j], (1 - p[i]) * size[i])    # words that may move from j to i
        m = up if draw[i] < down / (up + down) else -down
        p[j] += m / size[j]
        p[i] -= m / size[i]
        for k in (i, j):
            if abs(p[k] - round(p[k])) < _EPS:
                p[k] = round(p[k])
        open_at = i if 0 < p[i] < 1 else j if 0 < p[j] < 1 else -1
    return rows.set_column(rows.schema.get_field_index("p"), "p", pa.array(p))


def _hashed(*parts: Column) -> Column:
    """A uniform draw in [0, 1) from the values given."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") / float(1 << 52)


def mix(docs: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id",
        weights: tuple = WEIGHTS, max_copies: int = MAX_COPIES, seed: int = 7, group: int = GROUP,
        keep: list[str] | None = None, whole_only: bool = False) -> DataFrame:
    """``keep`` columns of ``docs`` plus ``size``, ``source_size``, ``target``,
    ``copies`` (0 to ``max_copies``), ``part_words`` (words of one more, partial
    copy; above 0 for one document of a source at most) and ``taken``."""
    keep = [c for c in (docs.columns if keep is None else keep)
            if c not in ("size", "source_size", "target", "copies", "part_words", "taken")]
    sized = docs.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(source_col).alias("_source"), n_words(text_col).alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col), text_of(text_col)).alias("_key"))
    # the text is read once: the sizes feed both the targets and the rounding
    sized = materialise(sized, "mix-sizes")
    per = materialise(targets(sized, "_source", weights, max_copies), "mix-targets")
    d = sized.join(per.withColumnRenamed("source", "_of"), F.col("_source").eqNullSafe(F.col("_of"))).drop("_of")
    ratio = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(max_copies)))
                   ).otherwise(F.lit(0.0))
    d = d.withColumns({"_whole": F.floor(ratio + _EPS).cast("int"), "_draw": _hashed(F.lit(seed), F.col("_key"))})
    d = d.withColumns({"p": F.greatest(ratio - F.col("_whole"), F.lit(0.0)),
                       "_at": F.floor(F.pmod(F.xxhash64(F.col("_key"), F.lit("group")), F.lit(1 << 30))
                                      * F.ceil(F.col("n_docs") / group) / (1 << 30))})
    largest = per.agg(F.max("n_docs")).first()[0] or 0
    groups = math.ceil(largest / group)
    rounded = materialise(d.groupBy("_source", "_at").applyInArrow(_pivot, d.schema), "mix-level")
    done, level = [], 0
    while groups > 1:
        done.append(rounded.where(F.col("p").isin(0.0, 1.0)))
        groups, level = math.ceil(groups / group), level + 1
        rest = rounded.where(~F.col("p").isin(0.0, 1.0)).withColumns({
            "_at": F.floor(F.col("_at") / group), "_draw": _hashed(F.lit(seed + level), F.col("_key"))})
        rounded = materialise(rest.groupBy("_source", "_at").applyInArrow(_pivot, d.schema), "mix-level")
    if whole_only:
        coin = _hashed(F.lit(seed), F.lit("last"), F.col("_key")) < F.col("p")
        rounded = rounded.withColumn("p", F.when(F.col("p").isin(0.0, 1.0), F.col("p")).otherwise(coin.cast("double")))
    out = rounded
    for d in done:
        out = out.unionByName(d)
    extra = F.floor(F.col("p"))
    part = F.round((F.col("p") - extra) * F.col("size")).cast("long")
    return (out.withColumns({"copies": (F.col("_whole") + extra).cast("int"), "part_words": part})
            .select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "size", "source_size", "target",
                    "copies", "part_words", (F.col("copies") * F.col("size") + F.col("part_words")).alias("taken")))


def repeat_rows(docs: DataFrame, **how) -> DataFrame:
    """``docs`` as the mix takes it: each row repeated ``copies`` times."""
    docs = materialise(docs.withColumn("_rid", F.monotonically_increasing_id()), "mix-rows")
    m = mix(docs, keep=["_rid"], whole_only=True, **how).where("copies > 0").select("_rid", "copies")
    m = m.select("_rid", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("_rid")
    return docs.join(m, "_rid").drop("_rid")


@register("op5_mix_sources")
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of every document so that sources meet their target sizes."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs, keep=["doc_id"]).select("doc_id", "size", "source_size", "target", "taken", "copies", "part_words")
