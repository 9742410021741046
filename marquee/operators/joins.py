"""A left join that stays balanced whatever the keys look like."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def balanced_left_join(left: DataFrame, right: DataFrame, key: str,
                       spread: str | None = None) -> DataFrame:
    """Join ``right``, which has one row per ``key``, to ``left``, which may have very many.

    Adaptive execution splits the partition of a hot key, but only if a shuffle feeds each
    side of the join directly. A side that was aggregated by the same key would be taken as
    it is, and nothing could be split. Joining on a key derived from ``key`` brings in both
    shuffles; on the side with one row per key that costs little.

    Rows whose key is missing would all meet in one partition. With ``spread`` they get a
    key made from that column, which matches nothing.
    """
    def tagged(tag: str, column: str) -> Column:
        return F.concat(F.lit(tag), F.col(column).cast("string"))

    match = tagged("=", key)
    left_key = match if spread is None else F.coalesce(match, tagged("~", spread))
    one_per_key = right.withColumn("_key", match).drop(key)
    return left.withColumn("_key", left_key).join(one_per_key, "_key", "left").drop("_key")
