"""Samples with a repeatable choice."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marquee import vocabulary as V
from marquee.functions.keys import shuffled_rank


def sample_n(df: DataFrame, n: int, key: str = "tconst", seed: int = V.SEED) -> DataFrame:
    """``n`` rows chosen by a seeded hash of the key; fewer if there are fewer.

    Each task keeps its best ``n`` rows and only those are merged; there is no full sort.
    """
    rank = shuffled_rank(df[key], seed)
    return df.orderBy(rank, key).limit(n)
