"""Repeatable per-row randomness from a hash of a key.

Draws depend only on (key, seed), never on partitioning or task order, so a
job gives the same answer at 1 or 10,000 partitions and after a retry. The
same expression is easy to write in any SQL engine:
``md5_unit = int(first 8 hex digits of md5(key || ':' || seed)) / 2^32``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _key_string(key: Column | str) -> Column:
    c = F.col(key) if isinstance(key, str) else key
    return c.cast("string")


def _hex_unit(hexstr: Column, slot: int) -> Column:
    """Uniform in [0, 1) from hex digits 8*slot+1 .. 8*slot+8 of an md5."""
    return F.conv(F.substring(hexstr, 8 * slot + 1, 8), 16, 10).cast("double") / F.lit(TWO_32)


def md5_unit(key: Column | str, seed) -> Column:
    """Uniform draw in [0, 1) from md5(key:seed)."""
    s = F.concat(_key_string(key), F.lit(":"), F.lit(str(seed)))
    return _hex_unit(F.md5(s), 0)


def hash_normal(key: Column | str, seed) -> Column:
    """Standard normal draw by Box-Muller from two uniforms taken from one
    md5(key:seed) (hex digits 1-8 and 9-16)."""
    h = F.md5(F.concat(_key_string(key), F.lit(":"), F.lit(str(seed))))
    u1, u2 = _hex_unit(h, 0), _hex_unit(h, 1)
    return F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u1)) * F.cos(F.lit(2 * math.pi) * u2)


def hash_noise(key: Column | str, scale: float, seed, kind: str = "uniform") -> Column:
    """Noise column: ``uniform`` in [-scale, scale) or ``normal`` with sd=scale."""
    if kind == "uniform":
        return (md5_unit(key, seed) * 2.0 - 1.0) * F.lit(scale)
    if kind == "normal":
        return hash_normal(key, seed) * F.lit(scale)
    raise ValueError(kind)
