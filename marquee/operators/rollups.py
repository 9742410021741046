"""Partial aggregates that are stored and merged, so that no row is read twice.

A partial row has, for a group and a load, the counts, sums, greatest values and sketches that merge.
Loads may be merged in any order and any grouping: by decade, or all decades together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 2 to this many registers: the standard error of a distinct count is 1.04 over their root.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)

SUMS = ("titles", "rated", "rating_sum", "total_votes", "high_rated")
GREATEST = ("max_votes", "max_rating")
# By sketch, the column counted.
SKETCHES = {"distinct_titles": "tconst", "distinct_genres": "genres"}


def partials(cleaned: DataFrame, by: Sequence[str] = ("decade",)) -> DataFrame:
    """The partial rows of one load. Map tasks combine; what is shuffled is a row per task and group."""
    sketches = [F.hll_sketch_agg(c, SKETCH_BITS).alias(name) for name, c in SKETCHES.items()]
    return cleaned.groupBy(*by).agg(
        F.count("*").alias("titles"), F.count("averagerating").alias("rated"),
        F.sum(F.col("averagerating").cast("double")).alias("rating_sum"),
        F.sum("numvotes").alias("total_votes"), F.sum("is_high_rated").alias("high_rated"),
        F.max("numvotes").alias("max_votes"), F.max("averagerating").alias("max_rating"), *sketches)


def merged(parts: DataFrame, by: Sequence[str] = ("decade",)) -> DataFrame:
    """One partial row per group, from any number of loads; a partial row again."""
    measures = [F.sum(c).alias(c) for c in SUMS] + [F.max(c).alias(c) for c in GREATEST]
    sketches = [F.hll_union_agg(name).alias(name) for name in SKETCHES]
    return parts.groupBy(*by).agg(*measures, *sketches) if by else parts.agg(*measures, *sketches)


def mean_rating(digits: int = 2) -> Column:
    return F.round(F.try_divide("rating_sum", "rated"), digits)


def decade_stats(parts: DataFrame) -> DataFrame:
    """The statistics view by decade, from partial rows."""
    return merged(parts).select(
        "decade", F.col("titles").alias("movie_count"), mean_rating().alias("avg_rating"), "max_rating",
        "total_votes", F.col("high_rated").alias("high_rated_count"))


def movies_per_decade(parts: DataFrame) -> DataFrame:
    return merged(parts).select("decade", F.col("titles").alias("movie_count"), mean_rating().alias("avg_rating"),
                                "max_votes").orderBy("decade")


def health(parts: DataFrame) -> DataFrame:
    """The health of all loads together; decades are counted from the groups."""
    return merged(parts, ()).join(parts.agg(F.count_distinct("decade").alias("decades_covered"))).select(
        F.col("titles").alias("total_records"), mean_rating(3).alias("mean_rating"), "decades_covered",
        F.col("high_rated").alias("high_rated_count"))


def distinct_counts(parts: DataFrame, by: Sequence[str] = ("decade",)) -> DataFrame:
    """Distinct values, within some ``SKETCH_ERROR`` of the exact count; exact for few."""
    return merged(parts, by).select(*by, *[F.hll_sketch_estimate(name).alias(name) for name in SKETCHES])


def job_partials(metrics: DataFrame) -> DataFrame:
    """Per day and job: how many events, completed and failed ones, and the sum of what they took."""
    return metrics.groupBy(F.to_date("ts").alias("day"), "job").agg(
        F.count("elapsed").alias("events"), F.sum("completed").alias("completed"), F.sum("failed").alias("failed"),
        F.sum("elapsed").alias("elapsed"))


def daily_average(parts: DataFrame) -> DataFrame:
    """The average that events of a day took, from partial rows of any number of loads."""
    added = parts.groupBy("day").agg(F.sum("elapsed").alias("elapsed"), F.sum("events").alias("events"))
    return added.select(F.unix_timestamp(F.col("day").cast("timestamp")).alias("window_start"),
                        F.try_divide("elapsed", "events").alias("avg_elapsed"))
