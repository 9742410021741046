"""Feature expressions. Each function returns named columns and touches no data.

Training and scoring both call these, so a request gets the same features as a title.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee import vocabulary as V

Named = dict[str, Column]


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def genre_flags(genres: Column) -> Named:
    return {V.flag_name(g): flag(genres.contains(g)) for g in V.GENRES}


def era_features(year: Column) -> Named:
    def between(start: int, end: int) -> Column:
        return flag((year >= start) & (year < end))

    return {
        "year_normalized": (year - V.FIRST_YEAR) / (V.LAST_YEAR - V.FIRST_YEAR),
        "is_modern": flag(year >= 2000),
        "is_classic": flag(year < 1970),
        "decade_2000s": between(2000, 2010),
        "decade_2010s": between(2010, 2020),
        "decade_2020s": flag(year >= 2020),
    }


def runtime_features(minutes: Column) -> Named:
    filled = F.coalesce(minutes.cast("double"), F.lit(V.TYPICAL_RUNTIME))
    return {
        "runtime_normalized": F.least(filled / V.RUNTIME_SCALE, F.lit(1.0)),
        "is_short_film": flag(filled < 60),
        "is_epic": flag(filled > 150),
    }


def log_votes(votes: Column) -> Column:
    return F.log(votes.cast("double") + 1)


def vote_features(votes: Column) -> Named:
    return {
        "votes_log": log_votes(votes),
        "votes_normalized": F.least(votes.cast("double") / V.VOTES_SCALE, F.lit(1.0)),
        "is_well_known": flag(votes >= 10000),
        "is_blockbuster": flag(votes >= 100000),
    }


def popularity_score(third: Column) -> Column:
    """Blockbusters weigh 3, well-known titles 2, and ``third`` adds 1."""
    return (F.col("is_blockbuster") * 3 + F.col("is_well_known") * 2 + flag(third)).cast("double")


def interaction_features() -> Named:
    """Columns computed from base features already present in the frame (without the bin)."""
    def on(name: str) -> Column:
        return F.col(name) == 1

    drama, documentary = on("genre_drama"), on("genre_documentary")
    return {
        "votes_log_squared": F.col("votes_log") * F.col("votes_log"),
        "popularity_score": popularity_score(F.col("votes_normalized") > 0.1),
        "is_drama_or_biography": flag(drama | on("genre_biography")),
        "is_action_adventure": flag(on("genre_action") & on("genre_adventure")),
        "is_horror_thriller": flag(on("genre_horror") | on("genre_thriller")),
        "long_drama": flag(on("is_epic") & drama),
        "classic_documentary": flag(on("is_classic") & documentary),
        "modern_documentary": flag(on("is_modern") & documentary),
    }
