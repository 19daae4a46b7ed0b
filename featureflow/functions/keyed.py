"""Reproducible pseudo-random values keyed by row id: same value on every engine and partitioning."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_BITS = 60


def _digits(seed: int | str, row_id: Column, start: int, length: int) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string")))
    return F.conv(F.substring(digest, start, length), 16, 10).cast("long")


def hash_key(seed: int | str, row_id: Column) -> Column:
    """Uniform long in [0, 2**60): the first 15 hex digits of md5('seed:row_id')."""
    return _digits(seed, row_id, 1, KEY_BITS // 4)


def uniform(seed: int | str, row_id: Column, part: int = 0) -> Column:
    """Uniform double in (0, 1) from one of the four 8-digit parts of the digest."""
    return (_digits(seed, row_id, 1 + 8 * part, 8) + F.lit(0.5)) / F.lit(float(2**32))


def standard_normal(seed: int | str, row_id: Column) -> Column:
    """Standard normal draw (Box-Muller on two uniforms)."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(uniform(seed, row_id, 0)))
    return radius * F.cos(F.lit(2.0 * math.pi) * uniform(seed, row_id, 1))
