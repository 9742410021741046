"""Feature matrices: 28 base columns, 37 with interactions, 43 with directors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import vocabulary as V
from marquee.functions import features as X
from marquee.functions.bins import EqualWidthBins
from marquee.functions.keys import percent_of
from marquee.sources.tables import only_missing, require_columns

# The columns of the enriched titles that the full matrix is made of.
MATRIX_INPUTS = ["tconst", "primarytitle", "startyear", "runtimeminutes", "genres", "averagerating", "numvotes",
                 "is_high_rated", *V.DIRECTOR_FEATURES]


def base_columns() -> dict[str, Column]:
    return {
        "target_rating": F.col("averagerating").cast("float"),
        **X.genre_flags(F.col("genres")),
        **X.era_features(F.col("startyear")),
        **X.runtime_features(F.col("runtimeminutes")),
        **X.vote_features(F.col("numvotes")),
    }


def feature_matrix(cleaned: DataFrame) -> DataFrame:
    """Ids, target and 28 base features, 33 columns. A projection: nothing moves."""
    return cleaned.withColumns(base_columns()).select(V.ID_COLUMNS + V.BASE_FEATURES)


def with_interactions(features: DataFrame, bins: EqualWidthBins) -> DataFrame:
    """Add the nine interaction features, as far as they are absent."""
    return only_missing(features, {
        **X.interaction_features(),
        "votes_log_binned": bins.index(F.col("votes_log")),
    })


def interaction_matrix(features: DataFrame, bins: EqualWidthBins) -> DataFrame:
    return require_columns(with_interactions(features, bins), V.ID_COLUMNS + V.INTERACTION_FEATURES)


def merge_directors(features: DataFrame, enriched: DataFrame) -> DataFrame:
    """Bring director columns to a stored feature matrix by title.

    Both tables have a row per title, so no key can be hot and titles join as they are.
    """
    slim = enriched.select("tconst", *V.DIRECTOR_FEATURES).dropDuplicates(["tconst"])
    return features.join(slim, "tconst", "left").na.fill(V.UNKNOWN_DIRECTOR)


def training_matrix(features: DataFrame, enriched: DataFrame, bins: EqualWidthBins) -> DataFrame:
    """Ids, target and all 43 features, nulls as 0, from the two stored tables."""
    merged = with_interactions(merge_directors(features, enriched), bins)
    return require_columns(merged, V.ID_COLUMNS + V.FULL_FEATURES).na.fill(0)


def training_matrix_in_one_pass(enriched: DataFrame, bins: EqualWidthBins) -> DataFrame:
    """The same matrix straight from the enriched titles.

    They already carry every input, so the features are a projection and the join of
    ``merge_directors`` is not needed.
    """
    wide = enriched.withColumns(base_columns())
    wide = with_interactions(wide, bins)
    return require_columns(wide, V.ID_COLUMNS + V.FULL_FEATURES).na.fill(0)


def is_reliable(votes: int = V.RELIABLE_VOTES) -> Column:
    """Whether log votes reach the log of ``votes``, so ``votes - 1`` is enough.

    The threshold is computed by the same engine function as the feature.
    """
    return F.col("votes_log") >= F.log(F.lit(float(votes)))


def reliable(features: DataFrame, votes: int = V.RELIABLE_VOTES) -> DataFrame:
    """The titles that ``is_reliable`` finds."""
    return features.filter(is_reliable(votes))


def with_split(df: DataFrame, train_percent: int = 80) -> DataFrame:
    """Mark each title as train or test by a hash of its key."""
    part = F.when(percent_of(F.col("tconst")) < train_percent, "train").otherwise("test")
    return df.withColumn("split", part)
