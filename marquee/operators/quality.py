"""Data-quality measures, counts and descriptions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import vocabulary as V
from marquee.operators import cleaning, reports
from marquee.operators.joins import balanced_left_join


def completeness(column: str, digits: int = 2) -> Column:
    """Percentage of rows in which ``column`` has a value; null if there are no rows."""
    return F.round(F.try_divide(F.count(column) * F.lit(100.0), F.count("*")), digits)


def completeness_report(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Row count and completeness; ``columns`` maps output names to columns."""
    return df.agg(
        reports.n_titles("total_movies"),
        *[completeness(c).alias(name) for name, c in columns.items()],
    )


def dq_completeness(cleaned: DataFrame) -> DataFrame:
    return completeness_report(cleaned, {
        "title_completeness": "primarytitle",
        "rating_completeness": "averagerating",
        "votes_completeness": "numvotes",
    })


def dq_health(cleaned: DataFrame) -> DataFrame:
    return cleaned.agg(
        reports.n_titles("total_records"),
        reports.mean_rating(3, "mean_rating"),
        F.count_distinct("decade").alias("decades_covered"),
        F.sum("is_high_rated").alias("high_rated_count"),
        completeness("primarytitle").alias("data_completeness_pct"),
    )


def dq_by_decade(cleaned: DataFrame) -> DataFrame:
    return cleaned.filter(F.col("decade").isNotNull()).groupBy("decade").agg(
        reports.n_titles("records"),
        reports.mean_rating(),
        F.count("runtimeminutes").alias("has_runtime"),
        completeness("runtimeminutes", 1).alias("runtime_completeness"),
    ).orderBy("decade")


# Stages that add columns to every cleaned title and no rows: they join sides with one row
# per title or director, or none at all.
ROW_FOR_ROW = ("enriched", "features")


def stage_counts(titles: DataFrame, ratings: DataFrame, credits: DataFrame,
                 **later: DataFrame) -> DataFrame:
    """Rows at each stage of the jobs, one row per stage.

    Titles meet ratings once and credits meet ratings once; the stages of ``ROW_FOR_ROW`` have
    the count of the cleaned titles. ``later`` names further stages, best given as stored tables;
    one of the same name as a row-for-row stage is counted instead.
    """
    same = [s for s in ROW_FOR_ROW if s not in later]
    clean = F.count_if(cleaning.is_clean())
    joined = cleaning.rated_movies(titles, ratings).agg(
        F.count("*").alias("joined"), clean.alias("clean"), *[clean.alias(s) for s in same]
    )
    basics = titles.agg(
        F.count("*").alias("titles"),
        F.count_if(F.col("titletype") == V.MOVIE_TYPE).alias("movies"),
    )
    # a director counts when at least one of their titles is rated
    rated = ratings.select("tconst").distinct().withColumn("rated", F.lit(True))
    directed = credits.filter(F.col("category") == V.DIRECTOR_CATEGORY).select("tconst", "nconst")
    directors = balanced_left_join(directed, rated, "tconst").agg(
        F.count("*").alias("director_entries"),
        F.count_distinct(F.when(F.col("rated"), F.col("nconst"))).alias("directors"),
    )
    plain = {"ratings": ratings, **later}
    counts = [df.agg(F.count("*").alias(stage)) for stage, df in plain.items()]
    long = [c.unpivot([], c.columns, "stage", "row_count")
            for c in (basics, joined, directors, *counts)]
    return reduce(DataFrame.unionByName, long)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """How often each value occurs; missing values are not counted."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))


def describe(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.count(column).alias("n"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
    )


def flag_totals(features: DataFrame, flags: Sequence[str] = V.GENRE_FLAGS,
                n: int = 8) -> DataFrame:
    """The ``n`` flags set most often. One row of sums is turned into rows."""
    sums = features.agg(*[F.sum(f).alias(f) for f in flags])
    return sums.unpivot([], list(flags), "flag", "total").orderBy(
        F.desc("total"), "flag"
    ).limit(n)


def flag_counts(enriched: DataFrame) -> DataFrame:
    """Conditional counts over enriched titles, in one pass."""
    year, minutes, votes = F.col("startyear"), F.col("runtimeminutes"), F.col("numvotes")
    return enriched.agg(
        F.count_if(minutes.isNull()).alias("null_runtimes"),
        F.count_if(year >= 2000).alias("modern"),
        F.count_if(year < 1970).alias("classic"),
        F.count_if(minutes < 60).alias("short_films"),
        F.count_if(minutes > 150).alias("epics"),
        F.count_if(votes >= 10000).alias("well_known"),
        F.count_if(votes >= 100000).alias("blockbusters"),
        F.count_if(F.col("has_known_director") == 1).alias("known_directors"),
    )
