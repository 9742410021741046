"""Director reputation: who directed what, and how their titles were rated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee import vocabulary as V
from marquee.functions.features import flag
from marquee.operators.cleaning import is_high_rated, typed_ratings
from marquee.operators.joins import balanced_left_join


def director_entries(credits: DataFrame) -> DataFrame:
    """Director credits with the billing order kept, so a first one can be chosen."""
    return credits.filter(F.col("category") == V.DIRECTOR_CATEGORY).select(
        "tconst", F.col("ordering").cast("int").alias("ordering"),
        F.col("nconst").alias("director_id"),
    )


def director_stats(entries: DataFrame, ratings: DataFrame) -> DataFrame:
    """One row per director over all their rated titles, of any type.

    Every aggregate has a map-side part, so a director with a third of all credits still
    reaches the final step as one partial row per task.
    """
    rating = F.col("averagerating")
    rated = entries.select("tconst", "director_id").join(typed_ratings(ratings), "tconst")
    stats = rated.groupBy("director_id").agg(
        F.count("*").alias("director_movie_count"),
        F.round(F.avg(rating), 3).alias("director_avg_rating"),
        F.round(F.avg("numvotes"), 0).alias("director_avg_votes"),
        F.max(rating).alias("director_max_rating"),
        F.round(F.avg(is_high_rated(rating)), 3).alias("director_hit_rate"),
    )
    return stats.withColumns({
        "director_votes_log": F.log(F.col("director_avg_votes") + 1),
        "has_known_director": flag(F.col("director_movie_count") >= 3),
    })


def primary_director(entries: DataFrame) -> DataFrame:
    """The first-billed director of each title; equal billing goes to the lower id.

    The least (ordering, director) pair is taken in every map task first, so a title with very
    many credits reaches the final step as one row per task.
    """
    first = F.min(F.struct("ordering", "director_id"))
    return (
        entries.groupBy("tconst").agg(first.alias("first"))
        .select("tconst", F.col("first.director_id").alias("director_id"))
    )


def with_directors(cleaned: DataFrame, primary: DataFrame, stats: DataFrame) -> DataFrame:
    """Cleaned titles with their director's stats, and fixed values where there is none.

    The two narrow sides meet first: one director may hold very many titles, so that join is
    balanced, and every row in it has a director. What comes out has a row per title and joins
    the wide rows by title, where they already lie after cleaning, so these do not move again.
    """
    known = balanced_left_join(primary, stats, "director_id")
    return cleaned.join(known, "tconst", "left").na.fill(V.UNKNOWN_DIRECTOR)


# --- without the title's own rating -----------------------------------------

def rated_titles(entries: DataFrame, ratings: DataFrame) -> DataFrame:
    """Each director's rated titles, once each; ratings in tenths, so that sums are exact."""
    tenths = F.round(F.col("averagerating").cast("double") * 10).cast("long")
    pairs = entries.select("tconst", "director_id").distinct()
    return pairs.join(typed_ratings(ratings), "tconst").select(
        "tconst", "director_id", tenths.alias("tenths"), F.col("numvotes").cast("long").alias("votes"),
        is_high_rated(F.col("averagerating")).cast("long").alias("hit"))


def _stats(n: Column, tenths: Column, votes: Column, hits: Column, most: Column) -> dict[str, Column]:
    """The reputation of ``n`` titles from their sums; null where there is none."""
    some = n > 0
    votes_log = F.log(F.round(F.try_divide(votes, n), 0) + 1)
    return {
        "director_movie_count": F.when(some, n),
        "director_avg_rating": F.round(F.try_divide(tenths / 10, n), 3),
        "director_hit_rate": F.round(F.try_divide(hits, n), 3),
        "director_votes_log": F.when(some, votes_log),
        "has_known_director": F.when(some, flag(n >= 3)),
        "director_max_rating": F.when(some, most / 10),
    }


def yearly_sums(rated: DataFrame, years: DataFrame) -> DataFrame:
    """Sums per director and year; ``years`` has ``tconst`` and ``startyear``. Titles without a year go.

    Every sum has a map-side part, so a director reaches the next step with a row per year,
    however many titles they have.
    """
    dated = rated.join(years.select("tconst", "startyear").filter("startyear is not null"), "tconst")
    return dated.groupBy("director_id", "startyear").agg(
        F.count("*").alias("n"), F.sum("tenths").alias("tenths"), F.sum("votes").alias("votes"),
        F.sum("hit").alias("hits"), F.max("tenths").alias("most"))


def stats_before(sums: DataFrame) -> DataFrame:
    """The reputation of each director before each of their years: titles of earlier years only."""
    earlier = Window.partitionBy("director_id").orderBy("startyear").rowsBetween(Window.unboundedPreceding, -1)
    added = [F.sum(c).over(earlier).alias(c) for c in ("n", "tenths", "votes", "hits")]
    before = sums.select("director_id", "startyear", *added, F.max("most").over(earlier).alias("most"))
    return before.select("director_id", "startyear", *[
        c.alias(name) for name, c in _stats(*map(F.col, ("n", "tenths", "votes", "hits", "most"))).items()])


def with_directors_before(cleaned: DataFrame, primary: DataFrame, before: DataFrame) -> DataFrame:
    """Cleaned titles with what was known of their director when they came out, and fixed values if nothing.

    A director's titles are spread by year, and adaptive execution splits a year that stays large.
    """
    key = F.concat_ws(":", "director_id", "startyear")
    directed = cleaned.join(primary, "tconst", "left").withColumn(
        "_when", F.when(F.col("director_id").isNotNull() & F.col("startyear").isNotNull(), key))
    dated = before.withColumn("_when", key).drop("director_id", "startyear")
    return balanced_left_join(directed, dated, "_when", "tconst").drop("_when").na.fill(V.UNKNOWN_DIRECTOR)


def director_sums(rated: DataFrame) -> DataFrame:
    """Sums per director, the two highest ratings, and how many titles have the highest.

    Titles are counted by director and rating first, of which there are at most 91 a director.
    """
    by_rating = rated.groupBy("director_id", "tenths").agg(
        F.count("*").alias("n"), F.sum("votes").alias("votes"), F.sum("hit").alias("hits"))
    ranked = F.sort_array(F.collect_list(F.struct("tenths", "n")), asc=False)
    return by_rating.groupBy("director_id").agg(
        F.sum("n").alias("n"), F.sum(F.col("tenths") * F.col("n")).alias("tenths"), F.sum("votes").alias("votes"),
        F.sum("hits").alias("hits"), F.slice(ranked, 1, 2).alias("highest"))


def with_other_titles(cleaned: DataFrame, primary: DataFrame, sums: DataFrame) -> DataFrame:
    """Cleaned titles with their director's reputation from all other titles, fixed values if there is none.

    Cleaned titles are rated, so their own figures are among the sums and are taken off again.
    """
    own = {"tenths": F.round(F.col("averagerating").cast("double") * 10).cast("long"), "votes": F.col("numvotes"),
           "hits": F.col("is_high_rated")}
    highest = F.col("_highest")
    alone = (highest[0]["tenths"] == own["tenths"]) & (highest[0]["n"] == 1)
    most = F.when(alone, F.get(highest, F.lit(1))["tenths"]).otherwise(highest[0]["tenths"])
    rest = _stats(F.col("_n") - 1, F.col("_tenths") - own["tenths"], F.col("_votes") - own["votes"],
                  F.col("_hits") - own["hits"], most)
    hidden = sums.withColumnsRenamed({c: f"_{c}" for c in sums.columns if c != "director_id"})
    known = cleaned.join(primary, "tconst", "left")
    joined = balanced_left_join(known, hidden, "director_id", "tconst")
    return joined.withColumns(rest).drop(*[c for c in hidden.columns if c != "director_id"]).na.fill(V.UNKNOWN_DIRECTOR)
