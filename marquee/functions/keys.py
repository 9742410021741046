"""Repeatable pseudo-random numbers from a row's key.

They depend on the key only, so a split or a sample stays the same however the data is
partitioned and whenever a lost task is run again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_of(key: Column) -> Column:
    """A whole number from 0 to 99 for each key."""
    digest = F.md5(key.cast("string"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100).cast("int")


def shuffled_rank(key: Column, seed: int) -> Column:
    """Ordering by this shuffles rows in a way fixed by ``seed``."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
