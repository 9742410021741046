"""Raw titles and ratings to the cleaned table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import vocabulary as V
from marquee.functions.bands import band
from marquee.functions.features import flag


TITLE_INPUTS = [
    "tconst", "titletype", "primarytitle", "originaltitle", "startyear",
    "runtimeminutes", "genres", "isadult",
]


def typed_titles(raw: DataFrame) -> DataFrame:
    """Cast the numeric title columns; text that is no number becomes null."""
    return raw.withColumns({
        c: F.col(c).try_cast("int") for c in ("startyear", "runtimeminutes", "isadult")
    })


def typed_ratings(raw: DataFrame) -> DataFrame:
    return raw.select(
        "tconst",
        F.col("averagerating").try_cast("float").alias("averagerating"),
        F.col("numvotes").try_cast("int").alias("numvotes"),
    )


def movies_only(titles: DataFrame) -> DataFrame:
    return titles.filter(F.col("titletype") == V.MOVIE_TYPE)


def rated_movies(titles: DataFrame, ratings: DataFrame) -> DataFrame:
    """Movies that have a rating, typed but not yet checked."""
    return typed_titles(movies_only(titles)).join(typed_ratings(ratings), "tconst", "inner")


def is_clean() -> Column:
    """Whether a rated movie has all critical values, in range. Never null."""
    complete = (
        F.col("tconst").isNotNull() & F.col("primarytitle").isNotNull()
        & F.col("startyear").isNotNull() & F.col("averagerating").isNotNull()
        & F.col("numvotes").isNotNull()
    )
    in_range = (
        (F.col("numvotes") >= V.MIN_VOTES)
        & F.col("startyear").between(V.FIRST_YEAR, V.LAST_YEAR)
        & F.col("averagerating").between(V.LOWEST_RATING, V.HIGHEST_RATING)
    )
    return complete & in_range


def rating_tier(rating: Column) -> Column:
    return band(rating, V.RATING_CUTS, V.RATING_TIERS)


def runtime_bucket(minutes: Column) -> Column:
    return band(minutes, V.RUNTIME_CUTS, V.RUNTIME_BUCKETS, closed=["left", "right"],
                missing="unknown")


def vote_tier(votes: Column) -> Column:
    return band(votes, V.VOTE_CUTS, V.VOTE_TIERS)


def is_high_rated(rating: Column) -> Column:
    return flag(rating >= V.HIGH_RATING)


def with_bands(df: DataFrame) -> DataFrame:
    """Add decade, tiers and the high-rating flag."""
    rating = F.col("averagerating")
    return df.withColumns({
        "decade": (F.floor(F.col("startyear") / 10) * 10).cast("int"),
        "rating_tier": rating_tier(rating),
        "runtime_bucket": runtime_bucket(F.col("runtimeminutes")),
        "is_high_rated": is_high_rated(rating),
        "vote_tier": vote_tier(F.col("numvotes")),
    })


def clean_titles(titles: DataFrame, ratings: DataFrame) -> DataFrame:
    """The cleaned table: rated movies with sound values, banded, 14 columns.

    One join on the title key. The filters on each side move below it on their own.
    """
    return finish(rated_movies(titles, ratings))


def finish(joined: DataFrame) -> DataFrame:
    """Keep the sound rows of the joined titles and give them their final columns."""
    return with_bands(joined.filter(is_clean())).select(V.CLEANED_COLUMNS)


def right_closed_bands(df: DataFrame) -> DataFrame:
    """The bands of the local check: a value on a cut falls into the band below.

    Values outside the outer bounds, and missing ones, get no label.
    """
    return df.withColumns({
        "rating_tier": band("averagerating", V.RATING_CUTS, V.RATING_TIERS, "right",
                            low=0, high=10),
        "runtime_bucket": band("runtimeminutes", V.RUNTIME_CUTS, V.RUNTIME_BUCKETS, "right",
                               low=0, high=9999),
        "vote_tier": band("numvotes", V.VOTE_CUTS, V.VOTE_TIERS, "right", low=0),
    })
