"""Deterministic pseudo-randomness: every draw is a hash of a seed and the row id.

Nothing here depends on partitioning, row order or how often a plan is evaluated,
so a recomputed task yields the same split, bag or shuffle as the first attempt.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: 16**12, the span of the twelve leading hex digits.
HEX_SPAN = 281474976710656

# P(X <= m) for a Poisson(1) count, m = 0..7.
POISSON_CDF = [sum(math.exp(-1.0) / math.factorial(i) for i in range(m + 1)) for m in range(8)]


def id_hash(seed, *parts) -> Column:
    """32 hex digits whose lexical order is a seeded random order of the ids."""
    return F.md5(F.concat_ws("~", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def hash_uniform(seed, *parts) -> Column:
    """Uniform double in [0, 1) from the hash of seed and id."""
    head = F.substring(id_hash(seed, *parts), 1, 12)
    return F.conv(head, 16, 10).cast("double") / F.lit(float(HEX_SPAN))


def poisson_count(u: Column) -> Column:
    """Smallest m with u <= P(X <= m); the bootstrap count of one row in one bag."""
    ladder = F.when(u <= POISSON_CDF[0], 0)
    for m, bound in enumerate(POISSON_CDF[1:], start=1):
        ladder = ladder.when(u <= bound, m)
    return ladder.otherwise(len(POISSON_CDF))


def tidy(value: Column, digits: int = 6) -> Column:
    """Rounded double without negative zero, for reports."""
    return F.round(value.cast("double"), digits) + F.lit(0.0)
