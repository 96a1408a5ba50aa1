"""Scalar column functions: formulas and molar mass, units, readings, clip,
sigmoid, response surfaces, repeatable noise and hash-driven choices.

Everything here is a ``Column`` expression evaluated inside whole-stage
codegen; array work uses higher-order functions over the row's own arrays.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialflow.functions.hashing import hash_normal, md5_unit

# Atomic weights (g/mol) used by the formula examples.
ATOMIC_WEIGHTS = {
    "H": 1.008, "C": 12.011, "N": 14.007, "O": 15.999, "Na": 22.990,
    "S": 32.06, "Cl": 35.45, "K": 39.10,
}

ELEMENT_PATTERN = r"([A-Z][a-z]?)([0-9]*)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _weights_map(weights: Mapping[str, float]) -> Column:
    return F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))])


def formula_terms(formula: Column | str) -> Column:
    """Array of (element, count) structs; a missing count means 1."""
    f = _c(formula)
    elems = F.regexp_extract_all(f, F.lit(ELEMENT_PATTERN), 1)
    nums = F.regexp_extract_all(f, F.lit(ELEMENT_PATTERN), 2)
    return F.transform(F.arrays_zip(elems.alias("e"), nums.alias("n")),
                       lambda t: F.struct(t["e"].alias("element"),
                                          F.when(t["n"] == "", F.lit(1)).otherwise(t["n"].cast("int")).alias("count")))


def molar_mass(formula: Column | str, weights: Mapping[str, float] = ATOMIC_WEIGHTS) -> Column:
    """Sum of count x atomic weight; NULL when an element is unknown or the
    text is not a plain formula (no parentheses or dots)."""
    f = _c(formula)
    wm = _weights_map(weights)
    terms = formula_terms(f)
    parts = F.transform(terms, lambda t: F.try_element_at(wm, t["element"]) * t["count"])
    total = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)
    ok = (F.regexp_replace(f, ELEMENT_PATTERN, "") == "") & (F.length(f) > 0)
    return F.when(ok & ~F.exists(parts, lambda x: x.isNull()), total)


def formula_error(formula: Column | str, weights: Mapping[str, float] = ATOMIC_WEIGHTS) -> Column:
    """Why ``molar_mass`` is NULL: 'unparsed' or 'unknown element: X, Y'."""
    f = _c(formula)
    wm = _weights_map(weights)
    unknown = F.array_distinct(F.filter(F.transform(formula_terms(f), lambda t: t["element"]),
                                        lambda e: F.try_element_at(wm, e).isNull()))
    return (F.when((F.regexp_replace(f, ELEMENT_PATTERN, "") != "") | (F.length(f) == 0), F.lit("unparsed"))
            .when(F.size(unknown) > 0, F.concat(F.lit("unknown element: "), F.array_join(unknown, ", "))))


def celsius_to_kelvin(c: Column | str) -> Column:
    return _c(c) + F.lit(273.15)


def grams_to_moles(mass_g: Column | str, molar_mass_g: Column | str) -> Column:
    return F.try_divide(_c(mass_g), _c(molar_mass_g))


def ml_to_grams(volume_ml: Column | str, density_g_ml: Column | str) -> Column:
    return _c(volume_ml) * _c(density_g_ml)


def parse_quantity(text: Column | str) -> Column:
    """Leading integer and unit ("25C", "298K") -> struct(value, unit, kelvin).
    Units C and K are understood; others give a NULL kelvin."""
    t = F.trim(_c(text))
    num = F.regexp_extract(t, r"^([0-9]+)", 1)
    value = F.when(num != "", num.cast("bigint"))
    unit = F.upper(F.trim(F.regexp_extract(t, r"^[0-9]*(.*)$", 1)))
    kelvin = (F.when(unit == "C", value.cast("double") + F.lit(273.15))
              .when(unit == "K", value.cast("double")))
    return F.struct(value.alias("value"), unit.alias("unit"), kelvin.alias("kelvin"))


def classify_reading(x: Column | str, pivot: float = 7.0,
                     labels: Sequence[str] = ("acidic", "neutral", "basic")) -> Column:
    """Below / equal / above the pivot (pH: acidic, neutral, basic)."""
    x = _c(x)
    return (F.when(x < pivot, F.lit(labels[0])).when(x > pivot, F.lit(labels[2]))
            .when(x == pivot, F.lit(labels[1])))


def log_offset(x: Column | str, eps: float = 1e-3) -> Column:
    return F.log10(_c(x) + F.lit(eps))


def clip(x: Column | str, lo: float | Column | None = None, hi: float | Column | None = None) -> Column:
    """Clamp to [lo, hi]; NULL stays NULL (greatest/least alone skip NULLs)."""
    x = _c(x)
    out = x
    if hi is not None:
        out = F.least(out, hi if isinstance(hi, Column) else F.lit(hi))
    if lo is not None:
        out = F.greatest(out, lo if isinstance(lo, Column) else F.lit(lo))
    return F.when(x.isNull(), None).otherwise(out)


def gaussian_response(terms: Sequence[tuple[Column | str, Column | float, Column | float, Column | float]],
                      base: Column | float = 0.0) -> Column:
    """``base + sum w * exp(-(x - mu)^2 / (2 sd^2))`` over (x, mu, sd, w) terms."""
    def lit(v):
        return v if isinstance(v, Column) else F.lit(float(v))
    out = lit(base)
    for x, mu, sd, w in terms:
        d = _c(x) - lit(mu)
        out = out + lit(w) * F.exp(-(d * d) / (F.lit(2.0) * lit(sd) * lit(sd)))
    return out


def hash_choice(key: Column | str, levels: Sequence[str], probs: Sequence[float], seed) -> Column:
    """Pick a level by cumulative probabilities with a repeatable hash draw."""
    u = md5_unit(key, seed)
    cum = 0.0
    expr = None
    for lv, p in zip(levels, probs):
        cum += p
        cond = u < F.lit(cum)
        expr = F.when(cond, F.lit(lv)) if expr is None else expr.when(cond, F.lit(lv))
    return expr.otherwise(F.lit(levels[-1]))


def hash_step(index: Column | str, n_levels: int, p_up: float, p_down: float, key: Column | str, seed) -> Column:
    """Move a level index one step up (prob ``p_up``) or down (``p_down``),
    clamped to [0, n_levels - 1]."""
    u = md5_unit(key, seed)
    i = _c(index)
    moved = F.when(u < p_up, i + 1).when(u < p_up + p_down, i - 1).otherwise(i)
    return F.greatest(F.lit(0), F.least(F.lit(n_levels - 1), moved))


def augment_conditions(df: DataFrame, key: Column | str, absolute: Mapping[str, float],
                       relative: Mapping[str, float], bounds: Mapping[str, tuple[float, float]],
                       seed, digits: int = 6) -> DataFrame:
    """Jitter columns with repeatable normal noise: absolute sd for some,
    relative (x * (1 + sd * z)) for others, then clip to bounds."""
    out = []
    for c in df.columns:
        e = F.col(c)
        if c in absolute:
            e = e + hash_normal(key, f"{seed}:{c}") * F.lit(absolute[c])
        elif c in relative:
            e = e * (F.lit(1.0) + hash_normal(key, f"{seed}:{c}") * F.lit(relative[c]))
        if c in bounds:
            lo, hi = bounds[c]
            e = clip(e, lo, hi)
        if c in absolute or c in relative:
            e = F.round(e, digits)
        out.append(e.alias(c))
    return df.select(*out)


def format_recipe(parts: Sequence[tuple[str, Column | str]], sep: str = ", ") -> Column:
    """``name=value`` pairs joined into one recipe string."""
    items = []
    for name, col in parts:
        items.append(F.concat(F.lit(f"{name}="), _c(col).cast("string")))
    return F.concat_ws(sep, *items)


def sigmoid_label(x: Column | str, threshold: float = 0.5) -> Column:
    return (F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(x))) >= threshold).cast("int")


PI = math.pi
