"""Randomness as a pure function of (seed, key).

A draw depends on nothing but its own row, so a recomputed task repeats it
exactly, and any engine with md5 can reproduce it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

def order_hash(seed: int | str, key: str | Column) -> Column:
    """32 hex digits; ordering rows by this string shuffles them uniformly."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def _fraction(hashed: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(hashed, start, digits), 16, 10).cast("double") / F.lit(16.0**digits)


def uniform(seed: int | str, key: str | Column, digits: int = 8) -> Column:
    """Uniform double in [0, 1) from the leading hex digits; 13 digits fill a double."""
    return _fraction(order_hash(seed, key), 1, digits)


def standard_normal(seed: int | str, key: str | Column) -> Column:
    """Box-Muller on two separate stretches of one hash; half a step keeps ln finite."""
    hashed = order_hash(seed, key)
    radius = F.sqrt(F.lit(-2.0) * F.log(_fraction(hashed, 1, 8) + F.lit(0.5 / 16.0**8)))
    return radius * F.cos(F.lit(2.0 * math.pi) * _fraction(hashed, 9, 8))
