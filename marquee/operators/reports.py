"""Reports, dashboard panels and views over the cleaned table.

Groups are few and every aggregate combines map-side, so each report is one scan of the
columns it names plus a tiny shuffle. Top lists have a total order: equal ratings are
settled by votes, then by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee import vocabulary as V


def n_titles(name: str = "movie_count") -> Column:
    return F.count("*").alias(name)


def mean_rating(digits: int = 2, name: str = "avg_rating") -> Column:
    return F.round(F.avg("averagerating"), digits).alias(name)


def total_votes() -> Column:
    return F.sum("numvotes").alias("total_votes")


def best_first() -> list[Column]:
    return [F.desc("averagerating"), F.desc("numvotes"), F.asc("tconst")]


def seen(df: DataFrame, votes: int) -> DataFrame:
    return df.filter(F.col("numvotes") >= votes)


# --- reports --------------------------------------------------------------

def movies_per_decade(cleaned: DataFrame) -> DataFrame:
    return cleaned.groupBy("decade").agg(
        n_titles(), mean_rating(), F.max("numvotes").alias("max_votes")
    ).orderBy("decade")


def tier_share(cleaned: DataFrame) -> DataFrame:
    """Titles per rating tier and the percentage of all. The window sees four rows."""
    tiers = cleaned.groupBy("rating_tier").agg(n_titles("count"))
    everything = F.sum("count").over(Window.partitionBy())
    share = F.round(F.col("count") * F.lit(100.0) / everything, 1)
    return tiers.withColumn("percentage", share).orderBy(F.desc("count"), "rating_tier")


def top_movies(cleaned: DataFrame, n: int = 20) -> DataFrame:
    return seen(cleaned, V.RELIABLE_VOTES).orderBy(best_first()).limit(n).select(
        "primarytitle", "startyear", "averagerating", "numvotes", "genres", "runtime_bucket"
    )


def genre_ranking(cleaned: DataFrame, at_least: int, *more: Column) -> DataFrame:
    """Genre combinations with enough titles of at least 1000 votes each."""
    return (
        seen(cleaned, 1000).groupBy("genres")
        .agg(n_titles(), mean_rating(), *more)
        .filter(F.col("movie_count") >= at_least)
    )


def best_genres(cleaned: DataFrame, n: int = 20) -> DataFrame:
    ranking = genre_ranking(cleaned, 50, total_votes())
    return ranking.orderBy(F.desc("avg_rating"), F.asc_nulls_last("genres")).limit(n)


def tier_trend(cleaned: DataFrame, since: int = 1960) -> DataFrame:
    recent = cleaned.filter(F.col("decade") >= since)
    return recent.groupBy("decade", "rating_tier").agg(n_titles("count")).orderBy(
        "decade", "rating_tier"
    )


def runtime_effect(cleaned: DataFrame) -> DataFrame:
    timed = cleaned.filter(F.col("runtime_bucket") != "unknown")
    return timed.groupBy("runtime_bucket").agg(
        n_titles("count"), mean_rating(), F.round(F.avg("numvotes"), 0).alias("avg_votes")
    ).orderBy(F.desc("avg_rating"), "runtime_bucket")


# --- panels ---------------------------------------------------------------

def panel_totals(cleaned: DataFrame) -> DataFrame:
    """Four single-number panels from one scan."""
    return cleaned.agg(
        n_titles("total_movies"), mean_rating(), total_votes(),
        F.sum("is_high_rated").alias("high_rated"),
    )


def panel_by_decade(cleaned: DataFrame, measure: Column) -> DataFrame:
    return cleaned.filter(F.col("decade").isNotNull()).groupBy("decade").agg(measure).orderBy(
        "decade"
    )


def panel_decade_count(cleaned: DataFrame) -> DataFrame:
    return panel_by_decade(cleaned, n_titles())


def panel_decade_rating(cleaned: DataFrame) -> DataFrame:
    return panel_by_decade(cleaned, mean_rating())


def panel_genres(cleaned: DataFrame, n: int = 15) -> DataFrame:
    ranking = genre_ranking(cleaned, 20)
    return ranking.orderBy(F.desc("avg_rating"), F.asc_nulls_last("genres")).limit(n)


def panel_tiers(cleaned: DataFrame, tier: str) -> DataFrame:
    """Titles per value of a tier column, largest first."""
    return cleaned.groupBy(tier).agg(n_titles()).orderBy(F.desc("movie_count"), tier)


# --- views ----------------------------------------------------------------

def decade_stats(cleaned: DataFrame) -> DataFrame:
    return cleaned.groupBy("decade").agg(
        n_titles(), mean_rating(), F.max("averagerating").alias("max_rating"),
        total_votes(), F.sum("is_high_rated").alias("high_rated_count"),
    )


def genre_stats(cleaned: DataFrame) -> DataFrame:
    return genre_ranking(
        cleaned, 50, total_votes(), F.sum("is_high_rated").alias("high_rated_count")
    )


def movies_summary(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(V.SUMMARY_COLUMNS)


def reliable_movies(cleaned: DataFrame) -> DataFrame:
    """Every title with enough votes, unordered; a reader sorts by ``best_first``."""
    return seen(cleaned, V.RELIABLE_VOTES).select(
        "primarytitle", "startyear", "genres", "averagerating", "numvotes",
        "rating_tier", "runtime_bucket",
    )


# --- small looks ----------------------------------------------------------

def top_by_votes(cleaned: DataFrame, n: int = 5) -> DataFrame:
    return cleaned.orderBy(F.desc("numvotes"), "tconst").limit(n).select(
        "primarytitle", "startyear", "averagerating", "numvotes"
    )


def title_search(titles: DataFrame, text: str) -> DataFrame:
    """Titles whose name contains ``text``; a missing name does not."""
    found = F.coalesce(F.col("primarytitle").contains(text), F.lit(False))
    return titles.filter(found).select("tconst", "primarytitle")
