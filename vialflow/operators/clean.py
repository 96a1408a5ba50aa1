"""Projections, filters, predicates and cleaning (all narrow, map-side jobs
except where a single scalar statistic is needed, which is a scalar
subquery evaluated once)."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialflow.operators.window import exact_quantiles


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def select(df: DataFrame, cols: Sequence) -> DataFrame:
    return df.select(*cols)


def where(df: DataFrame, cond: Column, cols: Sequence | None = None) -> DataFrame:
    """Filter then project; Catalyst pushes the predicate into the scan."""
    out = df.where(cond)
    return out.select(*cols) if cols else out


def slice_rows(df: DataFrame, order: Sequence, offset: int, n: int) -> DataFrame:
    """Rows ``offset .. offset+n-1`` of a defined order (TakeOrdered with
    offset: each partition keeps a bounded heap of ``offset + n`` rows)."""
    return df.orderBy(*[_c(o) for o in order]).offset(offset).limit(n)


def ratio_to_reference(df: DataFrame, value: str, ref_pred: Column, ref_order: Sequence,
                       out: str = "ratio", digits: int = 6) -> DataFrame:
    """``value / value_of_reference_row``; the reference row is the first row
    (by ``ref_order``) matching ``ref_pred``, taken as a scalar subquery."""
    ref = (df.where(ref_pred).orderBy(*[_c(o) for o in ref_order]).limit(1)
           .select(F.col(value).cast("double"))).scalar()
    return df.withColumn(out, F.round(F.try_divide(F.col(value).cast("double"), ref), digits))


def clean_range(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Keep rows with ``lo <= col <= hi`` (inclusive)."""
    return df.where(F.col(col).between(lo, hi))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per column with its NULL count (one scan, then unpivot)."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "n_null").select(
        "column", F.coalesce(F.col("n_null"), F.lit(0)).cast("bigint").alias("n_null"))


def fill_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace NULLs by the column mean (means are scalar subqueries)."""
    means = {c: df.agg(F.avg(F.col(c).cast("double"))).scalar() for c in cols}
    return df.select(*[F.coalesce(F.col(c).cast("double"), means[c]).alias(c) if c in means else F.col(c)
                       for c in df.columns])


def drop_incomplete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(cols))


def drop_all_null(df: DataFrame) -> DataFrame:
    return df.dropna(how="all")


def finite_only(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows whose features are all non-NULL, non-NaN and finite."""
    cond = F.lit(True)
    for c in cols:
        x = F.col(c).cast("double")
        cond = cond & x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))
    return df.where(cond)


def normalise_label(col: Column | str) -> Column:
    """trim, lower-case, '-' -> '_'."""
    return F.regexp_replace(F.lower(F.trim(_c(col))), "-", "_")


def encode_label(col: Column | str, mapping: Mapping[str, int]) -> Column:
    """Normalised label mapped to an int; unknown labels give NULL."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(int(v)))])
    return F.try_element_at(m, normalise_label(col))


def cut(col: Column | str, edges: Sequence[float], labels: Sequence) -> Column:
    """Right-closed bins ``(e[i], e[i+1]]``; the lowest edge is included."""
    x = _c(col)
    expr = None
    for i, lab in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        cond = (x >= lo) if i == 0 else (x > lo)
        cond = cond & (x <= hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def binarize(df: DataFrame, col: str, rule: str | float, out: str = "label") -> DataFrame:
    """1 when ``col <= threshold``; ``rule='median'`` uses the exact median."""
    t = (exact_quantiles(df, col, (0.5,)).select(F.col("_q")[0]).scalar() if rule == "median"
         else F.lit(float(rule)))
    return df.withColumn(out, F.when(F.col(col).isNull(), None)
                         .otherwise((F.col(col) <= t).cast("int")))


def compound_label(rules: Sequence[Column]) -> Column:
    """1 when every rule holds (e.g. yield > 0.75 and repro >= 0.75 and purity > 0.5)."""
    cond = rules[0]
    for r in rules[1:]:
        cond = cond & r
    return cond.cast("int")


def contains(df: DataFrame, col: str, s: str) -> DataFrame:
    return df.where(F.col(col).contains(s))


def validate_levels(df: DataFrame, key: Sequence[str], levels: Mapping[str, DataFrame]) -> DataFrame:
    """Rows whose value in a column is not one of its declared levels.

    ``levels`` maps column -> one-column level table. Each check is a left anti
    join against a level table (small: broadcast by AQE when its size allows).
    Returns key columns, the column name and the offending value as text.
    """
    out = None
    for c, lv in levels.items():
        lv = lv.select(F.col(lv.columns[0]).alias(c)).distinct()
        bad = df.select(*key, c).join(lv, c, "left_anti").select(
            *key, F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        out = bad if out is None else out.unionByName(bad)
    return out


def validate_grid(spec: DataFrame, name: str = "name", start: str = "start", end: str = "end",
                  step: str = "step") -> DataFrame:
    """Check grid specs: positive step and (end - start) divisible by step
    (within 1e-9). Adds ``ok`` and ``reason``."""
    ratio = F.try_divide(F.col(end) - F.col(start), F.col(step))
    bad_step = F.col(step).isNull() | (F.col(step) <= 0)
    not_div = F.abs(ratio - F.round(ratio, 0)) > F.lit(1e-9)
    reason = (F.when(bad_step, F.lit("step must be above zero"))
              .when(not_div, F.lit("steps do not reach the end exactly")))
    return spec.select("*", reason.isNull().alias("ok"), reason.alias("reason"))
