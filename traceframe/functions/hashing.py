"""Portable pseudo-random numbers: every random choice is a hash of a seed and a key.

The same strings hash alike in any SQL engine, so a sample, a split or a label
can be reproduced anywhere and does not depend on partitioning or row order.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def digest(seed: str, *keys) -> Column:
    """Lower-case hex md5 of ``seed:key1:key2...``."""
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]).cast("binary"))


def uniform(seed: str, *keys) -> Column:
    """A number in [0, 1) from the first 32 bits of the digest."""
    head = F.conv(F.substring(digest(seed, *keys), 1, 8), 16, 10)
    return head.cast("double") / F.lit(4294967296.0)


def three_way_label(seed: str, *keys) -> Column:
    """Class 0 / 1 / 2 with shares 50 / 30 / 20 percent."""
    u = uniform(seed, *keys)
    return F.when(u < 0.5, F.lit(0)).when(u < 0.8, F.lit(1)).otherwise(F.lit(2)).cast("long")
