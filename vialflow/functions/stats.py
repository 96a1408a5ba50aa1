"""Closed-form statistical column functions kept inside codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Abramowitz & Stegun 7.1.26 rational approximation of erf,
# |error| < 1.5e-7. Neither Spark nor DuckDB ships erf.
AS_P = 0.3275911
AS_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def erf(x: Column | str) -> Column:
    x = _c(x)
    ax = F.abs(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(AS_P) * ax)
    a1, a2, a3, a4, a5 = AS_A
    poly = t * (F.lit(a1) + t * (F.lit(a2) + t * (F.lit(a3) + t * (F.lit(a4) + t * F.lit(a5)))))
    y = F.lit(1.0) - poly * F.exp(-ax * ax)
    return F.when(x < 0, -y).otherwise(y)


def norm_cdf(z: Column | str) -> Column:
    return F.lit(0.5) * (F.lit(1.0) + erf(_c(z) / F.lit(math.sqrt(2.0))))


def norm_pdf(z: Column | str) -> Column:
    z = _c(z)
    return F.exp(F.lit(-0.5) * z * z) / F.lit(math.sqrt(2 * math.pi))


def sigmoid(x: Column | str) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(x)))


def rnd(x: Column | str, digits: int = 6) -> Column:
    return F.round(_c(x), digits)


# Nudge applied before rounding values that are exact decimal ties by
# construction (means of few-decimal inputs): float summation order would
# otherwise decide the last digit. Far below the output precision.
TIE_NUDGE = 1e-9


def rnd_half_up(x: Column | str, digits: int = 6) -> Column:
    x = _c(x)
    return F.round(x + F.signum(x) * F.lit(TIE_NUDGE), digits)
