"""Synthetic spectra and their augmented views, as per-row array columns.

Fixed values: the wavenumber grid is 600 points from 400 to 1800
(inclusive, evenly spaced); the view applies a baseline slope (sd 0.0004 per
point from the centre), point noise (sd 0.02), an intensity scale
(1 + sd 0.03) and min-max normalisation. All draws are hash-seeded per row
(and per point for the noise), so a view is reproducible anywhere.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from vialflow.functions.hashing import TWO_32

GRID_N = 600
GRID_LO = 400.0
GRID_HI = 1800.0


def grid_x(i: Column) -> Column:
    return F.lit(GRID_LO) + i.cast("double") * F.lit((GRID_HI - GRID_LO) / (GRID_N - 1))


def spectrum(peaks: Sequence[tuple[Column, Column, Column]]) -> Column:
    """Sum of Gaussian peaks ``amp * exp(-0.5 ((x - mu) / sig)^2)`` on the grid."""
    def at(i):
        x = grid_x(i)
        out = F.lit(0.0)
        for mu, sig, amp in peaks:
            out = out + amp * F.exp(F.lit(-0.5) * ((x - mu) / sig) * ((x - mu) / sig))
        return out
    return F.transform(F.sequence(F.lit(0), F.lit(GRID_N - 1)), at)


def _unit(key: Column, slot: int = 0) -> Column:
    return F.conv(F.substring(F.md5(key), 8 * slot + 1, 8), 16, 10).cast("double") / F.lit(TWO_32)


def _normal(key: Column) -> Column:
    return F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - _unit(key, 0))) * F.cos(F.lit(2 * math.pi) * _unit(key, 1))


def augment(spec: Column, key: Column, seed) -> Column:
    """Baseline slope, point noise and intensity scale applied to a spectrum
    array (normalise the result with ``minmax``)."""
    k = F.concat(key.cast("string"), F.lit(f":{seed}"))
    slope = _normal(F.concat(k, F.lit(":slope"))) * F.lit(0.0004)
    scale = F.lit(1.0) + _normal(F.concat(k, F.lit(":scale"))) * F.lit(0.03)
    centre = (GRID_N - 1) / 2.0
    return F.transform(spec, lambda y, i: (y + slope * (i.cast("double") - F.lit(centre))
                                           + _normal(F.concat(k, F.lit(":"), i.cast("string"))) * F.lit(0.02)) * scale)


def _bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once per row, however often used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def minmax(a: Column) -> Column:
    """Min-max normalise an array, its bounds computed once per row; a flat
    array is copied."""
    def scaled(b: Column) -> Column:
        return F.when(b["hi"] - b["lo"] < 1e-9, b["a"]).otherwise(F.transform(b["a"], lambda v: (v - b["lo"]) / (b["hi"] - b["lo"])))

    return _bound(a, lambda x: _bound(F.struct(x.alias("a"), F.array_min(x).alias("lo"), F.array_max(x).alias("hi")), scaled))


def warp(y: Column, key: Column, seed, max_shift: int = 4, scale_sd: float = 0.015) -> Column:
    """Shift and stretch an array along its index: the value of place i moves to
    (i - shift) * scale, kept within the array, and places in between are
    interpolated. Shift is a whole number up to ``max_shift`` either way. NULL
    and empty arrays stay; a place next to a NULL becomes NULL."""
    k = F.concat(key.cast("string"), F.lit(f":{seed}:"))
    shift = F.floor(_unit(F.concat(k, F.lit("shift"))) * (2 * max_shift + 1)).cast("int") - max_shift
    scale = F.lit(1.0) + _normal(F.concat(k, F.lit("stretch"))) * scale_sd

    def moved(b: Column) -> Column:
        n, by = F.size(b["y"]), b["scale"]

        def place(i):
            return F.least(F.greatest((i - b["shift"]) * by, F.lit(0.0)), (n - 1).cast("double"))

        def at(j):
            low = F.least(F.greatest(F.floor(j / by + b["shift"]).cast("int"), F.lit(0)), F.greatest(n - 2, F.lit(0)))
            from_, to = F.get(b["y"], low), F.get(b["y"], F.least(low + 1, n - 1))
            share = (j - place(low)) / (place(low + 1) - place(low))
            return (F.when(j >= place(n - 1), F.get(b["y"], n - 1)).when(j < place(F.lit(0)), F.get(b["y"], F.lit(0)))
                    .otherwise(from_ + (to - from_) * share))

        return F.when(n == 0, b["y"]).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), at))

    return F.when(y.isNotNull(), _bound(F.struct(y.alias("y"), shift.alias("shift"), scale.alias("scale")), moved))


def dropout(y: Column, key: Column, seed, max_width: int = 35, min_width: int = 6, p: float = 0.5) -> Column:
    """With probability ``p`` replace one band of an array by a fifth of the line
    between its two ends. Bands are ``min_width`` to ``max_width`` places wide,
    but no wider than the array. NULL and empty arrays stay."""
    k = F.concat(key.cast("string"), F.lit(f":{seed}:"))
    width = F.least(F.floor(_unit(F.concat(k, F.lit("width"))) * (max_width - min_width + 1)).cast("int") + min_width, F.size(y))
    start = F.floor(_unit(F.concat(k, F.lit("start"))) * (F.size(y) - width + 1)).cast("int")
    some = (_unit(F.concat(k, F.lit("band"))) < p) & (F.size(y) > 0)

    def masked(b: Column) -> Column:
        left, right = F.get(b["y"], b["start"]), F.get(b["y"], b["start"] + b["width"] - 1)

        def at(v, i):
            line = left + (right - left) * (i - b["start"]) / F.greatest(b["width"] - 1, F.lit(1))
            return F.when((i >= b["start"]) & (i < b["start"] + b["width"]), line * 0.2).otherwise(v)

        return F.when(b["some"], F.transform(b["y"], at)).otherwise(b["y"])

    return F.when(y.isNotNull(), _bound(F.struct(y.alias("y"), start.alias("start"), width.alias("width"), some.alias("some")), masked))


def array_view(y: Column, key: Column, seed) -> Column:
    """A view of any given array: warped, with one band dropped at random,
    and min-max normalised (a flat array is copied)."""
    warped = warp(y.cast("array<double>"), key, seed)
    return minmax(_bound(warped, lambda w: dropout(w, key, seed)))
