"""Splits and feature preparation.

Splits and folds come from a hash of (id, seed), so they are repeatable at
any partition count and after task retries (``randomSplit`` is not). Exact
per-class quotas need ranks inside a class; those ranks are distributed
running counts over ranges of the hash order (``window.running``), so a class that
holds most rows is still ranked by many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialflow.functions.hashing import md5_unit
from vialflow.operators.window import RANGE, running


def split(df: DataFrame, id_col: str, frac: float, seed, out: str = "split") -> DataFrame:
    """'train' when md5_unit(id, seed) < frac, else 'test'."""
    return df.withColumn(out, F.when(md5_unit(id_col, seed) < frac, "train").otherwise("test"))


def _rank_in_class(df: DataFrame, id_col: str, y: str | None, seed) -> DataFrame:
    u = md5_unit(id_col, seed)
    d = df.withColumn("_u", u).withColumn("_one", F.lit(1))
    by = [y] if y else []
    r = running(d, ["_u", id_col], {"_rank": ("count", "_one")}, by, block=RANGE)
    return r.drop("_one")


def split_stratified(df: DataFrame, id_col: str, y: str, frac: float, seed, out: str = "split") -> DataFrame:
    """Per class, the first round(frac * n_class) rows in hash order are
    'train'. Classes with fewer than 2 rows fall back to the plain hash split."""
    r = _rank_in_class(df, id_col, y, seed)
    n = df.groupBy(y).agg(F.count(F.lit(1)).alias("_n"))
    j = r.join(n, y)
    quota = F.floor(F.col("_n") * F.lit(frac) + F.lit(0.5))
    lab = (F.when(F.col("_n") < 2, F.when(F.col("_u") < frac, "train").otherwise("test"))
           .when(F.col("_rank") <= quota, "train").otherwise("test"))
    return j.select(*df.columns, lab.alias(out))


def kfold(df: DataFrame, id_col: str, k: int, seed, y: str | None = None, out: str = "fold") -> DataFrame:
    """Fold = (rank in hash order, within the class when ``y`` is given) mod k."""
    r = _rank_in_class(df, id_col, y, seed)
    return r.select(*df.columns, ((F.col("_rank") - 1) % k).cast("int").alias(out))


def fit_scaler(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: mean and population std (ddof 0) per column."""
    exprs = []
    for c in cols:
        exprs += [F.avg(F.col(c).cast("double")).alias(f"{c}__mean"),
                  F.stddev_pop(F.col(c).cast("double")).alias(f"{c}__std")]
    return train.agg(*exprs)


def apply_scaler(df: DataFrame, scaler: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / std with the fitted one-row scaler (std 0 -> divide by 1)."""
    j = df.crossJoin(F.broadcast(scaler))  # one row
    out = []
    for c in df.columns:
        if c in cols:
            sd = F.col(f"{c}__std")
            out.append(((F.col(c) - F.col(f"{c}__mean")) / F.when((sd == 0) | sd.isNull(), 1.0).otherwise(sd)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def fit_minmax(train: DataFrame, cols: Sequence[str], bounds: dict | None = None) -> DataFrame:
    """One row of min/max per column (declared bounds override the data)."""
    bounds = bounds or {}
    exprs = []
    for c in cols:
        if c in bounds:
            exprs += [F.lit(float(bounds[c][0])).alias(f"{c}__min"), F.lit(float(bounds[c][1])).alias(f"{c}__max")]
        else:
            exprs += [F.min(F.col(c).cast("double")).alias(f"{c}__min"), F.max(F.col(c).cast("double")).alias(f"{c}__max")]
    return train.agg(*exprs)


def apply_minmax(df: DataFrame, mm: DataFrame, cols: Sequence[str], invert: bool = False) -> DataFrame:
    """Scale to [0, 1] (or invert back); a zero span scales to 0."""
    j = df.crossJoin(F.broadcast(mm))  # one row
    out = []
    for c in df.columns:
        if c in cols:
            lo, hi = F.col(f"{c}__min"), F.col(f"{c}__max")
            span = hi - lo
            if invert:
                e = F.col(c) * span + lo
            else:
                e = F.when(span == 0, F.lit(0.0)).otherwise((F.col(c) - lo) / span)
            out.append(e.alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def category_levels(train: DataFrame, col: str) -> list:
    """Distinct levels of a categorical column, sorted. This is the one place
    a value list reaches the driver: output column names must be known when
    the plan is built, and a category's level count is small by nature."""
    return [r[0] for r in train.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col).collect()]


def one_hot(df: DataFrame, col: str, levels: Sequence) -> DataFrame:
    """``<col>_<level>`` 0/1 columns; an unseen category is all zeros."""
    return df.select("*", *[(F.col(col) == F.lit(lv)).cast("int").alias(f"{col}_{lv}") for lv in levels])


def text_features(text: Column | str) -> list[Column]:
    """Numeric descriptors of a text (whole text): length, words, lines,
    digit / upper-case / punctuation shares, mean word length."""
    t = F.col(text) if isinstance(text, str) else text
    n = F.length(t)
    # compiled functions only; an array lambda would be interpreted per word
    n_words = F.size(F.array_remove(F.split(t, r"\s+"), ""))
    in_words = F.length(F.regexp_replace(t, r"\s+", ""))

    def share(pattern):
        return F.when(n == 0, F.lit(0.0)).otherwise(
            (n - F.length(F.regexp_replace(t, pattern, ""))).cast("double") / n)

    return [n.cast("bigint").alias("n_chars"), n_words.cast("bigint").alias("n_words"),
            F.size(F.split(t, "\n")).cast("bigint").alias("n_lines"),
            F.round(share("[0-9]"), 6).alias("digit_share"),
            F.round(share("[A-Z]"), 6).alias("upper_share"),
            F.round(share(r"[.,;:!?]"), 6).alias("punct_share"),
            F.round(F.when(n_words == 0, F.lit(0.0)).otherwise(in_words.cast("double") / n_words), 6).alias("mean_word_len")]


def normalise_for_shingles(text: Column | str) -> Column:
    """Lower-cased text with whitespace runs collapsed to one space."""
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.lower(t), r"\s+", " ")


def shingles(norm_col: str, n: int = 3) -> Column:
    """Character n-grams of an already normalised text column (pass a column
    name, so the text is computed once per row, not once per n-gram)."""
    t = F.col(norm_col)
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(t) - n + 1, F.lit(1))),
                       lambda i: F.substr(t, i, F.lit(n)))


# Per-Python-worker cache of n-gram -> md5 prefix (workers are reused across
# tasks). Bounded: cleared when it grows past _CACHE_MAX entries.
_GRAM_CACHE: dict = {}
_CACHE_MAX = 2_000_000


def _gram_hash(g: str) -> int:
    h = _GRAM_CACHE.get(g)
    if h is None:
        if len(_GRAM_CACHE) >= _CACHE_MAX:
            _GRAM_CACHE.clear()
        h = int(hashlib.md5(g.encode("utf-8")).hexdigest()[:8], 16)
        _GRAM_CACHE[g] = h
    return h


def _bits_udf(n_bits: int, n: int):
    @F.pandas_udf("array<int>")
    def bits(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            if t is None:
                out.append(None)
                continue
            grams = {t[i:i + n] for i in range(len(t) - n + 1)}  # each distinct n-gram once
            out.append(np.array(sorted({_gram_hash(g) % n_bits for g in grams}), dtype=np.int32))
        return pd.Series(out)

    return bits


def fingerprint(df: DataFrame, id_col: str, text: str, n_bits: int = 1024, n: int = 3) -> DataFrame:
    """Hashed character n-gram fingerprint per row: (id, bits) where bits are
    the sorted distinct positions md5(n-gram) mod n_bits, over the whole
    normalised text.

    Hashing every n-gram of a text is per-row work with no Spark operator:
    it runs as an Arrow-batched pandas UDF over the partitions (array
    lambdas would be interpreted per element, and exploding positions would
    copy the text into every n-gram row).
    """
    d = df.select(id_col, normalise_for_shingles(text).alias("_norm"))
    return d.select(id_col, _bits_udf(n_bits, n)("_norm").alias("bits"))


def pack_bits(bits: Column, n_bits: int = 1024, word: int = 32) -> Column:
    """Bit positions -> array of ``n_bits / word`` BIGINT words (bit b of a
    word = position word*w + b)."""
    words = F.sequence(F.lit(0), F.lit(n_bits // word - 1))
    return F.transform(words, lambda w: F.aggregate(
        F.filter(bits, lambda b: F.floor(b / word) == w), F.lit(0).cast("bigint"),
        lambda acc, b: acc + F.pow(F.lit(2.0), b % word).cast("bigint")))


def canonical_text(text: Column | str) -> Column:
    """Lower case, markup removed, whitespace collapsed and trimmed."""
    t = F.col(text) if isinstance(text, str) else text
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(t), r"<[^>]*>", " "), r"\s+", " "))


def skeleton_text(text: Column | str) -> Column:
    """Structural skeleton: letters -> 'a', digits -> '0', whitespace collapsed."""
    t = canonical_text(text)
    return F.regexp_replace(F.regexp_replace(t, r"[0-9]+", "0"), r"[^ 0.,;:!?]+", "a")


def sample_n(df: DataFrame, id_col: str, n: int, seed) -> DataFrame:
    """Repeatable sample of ``n`` rows: smallest hash(id, seed), id on ties."""
    return (df.withColumn("_u", md5_unit(id_col, seed)).orderBy("_u", id_col).limit(n).drop("_u"))
