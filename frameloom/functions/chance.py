"""Random numbers that are a function of a seed and a place, so they are the same under any partitioning, order or repetition."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(seed: int, *place: Column | str) -> Column:
    """A number in [0, 1) for (seed, *place): 48 bits of the digest of their text. A null part is the word null, told from the text 'null' by a mark."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))
    text = F.concat_ws("/", F.lit(str(seed)), *[part(F.col(c) if isinstance(c, str) else c) for c in place])
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long") / float(1 << 48)


def between(low: float, high: float, u: Column) -> Column:
    return low + (high - low) * u


def integer(low: int, high: int, u: Column) -> Column:
    """An integer from low to high, both included."""
    return (F.floor(u * (high - low + 1)) + low).cast("int")


def normal(mean: Column | float, deviation: Column | float, u: Column, v: Column) -> Column:
    """A normal number from two uniform ones; the first is kept from 0."""
    return mean + deviation * F.sqrt(-2 * F.ln(1 - u)) * F.cos(2 * math.pi * v)
