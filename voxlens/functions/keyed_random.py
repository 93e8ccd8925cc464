"""Deterministic pseudo-random numbers derived from a row key.

Values depend only on the key (and a salt), never on partitioning, task order
or retries, so a recomputed partition after executor loss yields the same
numbers. Uniforms come from 32 bits of ``md5(salt:key)``; normals use the
Box-Muller transform over two independent 32-bit slices.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def _hash32(key: Column, salt: str, start: int) -> Column:
    digest = F.md5(F.concat(F.lit(f"{salt}:"), F.coalesce(key.cast("string"), F.lit(""))))  # a NULL key draws too
    return F.conv(F.substring(digest, start, 8), 16, 10).cast("long")


def uniform(key: Column, salt: str = "u", start: int = 1) -> Column:
    """Uniform in (0, 1): ``(h + 0.5) / 2^32``."""
    return (_hash32(key, salt, start) + F.lit(0.5)) / F.lit(TWO_POW_32)


def normal(key: Column, salt: str = "n", sd: float = 1.0) -> Column:
    """N(0, sd^2) by Box-Muller from two key-derived uniforms."""
    u1 = uniform(key, salt, 1)
    u2 = uniform(key, salt, 9)
    return F.lit(sd) * F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)
