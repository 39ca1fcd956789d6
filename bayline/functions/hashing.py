"""Replayable random numbers from keys.

The same key and salt give the same number whatever the partitioning, so a retried
task or a second run draws the same sample. Every draw takes a salt of its own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_uniform(key: Column, salt: str | Column) -> Column:
    """Uniform number in [0, 1) from the first 32 bits of md5(salt:key)."""
    salt = salt if isinstance(salt, Column) else F.lit(salt)
    digest = F.md5(F.concat(salt, F.lit(":"), key.cast("string")))
    return digest_uniform(digest, 0)


def digest_uniform(digest: Column, part: int) -> Column:
    """Uniform number from one of the four 32-bit parts of an md5 digest."""
    piece = F.substring(digest, 8 * part + 1, 8)
    return F.conv(piece, 16, 10).cast("bigint") / F.lit(float(2**32))


def poisson1(u: Column) -> Column:
    """Poisson(1) count by inversion of a uniform number (up to 13 at 32 bits)."""
    bounds, total = [], 0.0
    for k in range(13):
        total += math.exp(-1.0) / math.factorial(k)
        bounds.append(total)
    count = F.lit(0)
    for bound in bounds:
        count = count + (u >= F.lit(bound)).cast("int")
    return count
