"""The three batch jobs, the training data, the models and scoring, from raw files on.

Row counts are observed while the rows of a write pass by, instead of by an action each.
They are for the log: a task run again after a failure may be counted twice. For exact
numbers use ``quality.stage_counts``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marquee.functions.bins import EqualWidthBins
from marquee.operators import cleaning, matrix, models, reputation, scoring
from marquee.sources import catalog, tables, tsv


@dataclass(frozen=True)
class Lake:
    """Where the stored tables are, below one root."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    seen = Observation(name)
    return df.observe(seen, F.count("*").alias("rows")), seen


def read_raw(spark: SparkSession, titles: str, ratings: str, credits: str,
             partitions: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three raw files, their headers checked."""
    return (
        tsv.read_tsv(spark, titles, tsv.TITLE_COLUMNS, partitions),
        tsv.read_tsv(spark, ratings, tsv.RATING_COLUMNS, partitions),
        tsv.read_tsv(spark, credits, tsv.CREDIT_COLUMNS, partitions),
    )


def store_cleaned(titles: DataFrame, ratings: DataFrame, lake: Lake) -> dict[str, int]:
    titles, n_titles = counted(titles.select(cleaning.TITLE_INPUTS), "titles")
    ratings, n_ratings = counted(ratings, "ratings")
    joined, n_joined = counted(cleaning.rated_movies(titles, ratings), "joined")
    clean, n_clean = counted(cleaning.finish(joined), "clean")
    tables.write_cleaned(clean, lake.path("cleaned"))
    catalog.register_stored(clean.sparkSession, lake.path("cleaned"))
    return {
        "titles": n_titles.get["rows"], "ratings": n_ratings.get["rows"],
        "joined": n_joined.get["rows"], "clean": n_clean.get["rows"],
    }


def store_features(spark: SparkSession, lake: Lake) -> dict[str, int]:
    cleaned = tables.read_table(spark, lake.path("cleaned"))
    features, n = counted(matrix.feature_matrix(cleaned), "features")
    tables.write_flat(features, lake.path("features"))
    return {"features": n.get["rows"]}


def store_directors(spark: SparkSession, credits: DataFrame, ratings: DataFrame,
                    lake: Lake) -> dict[str, int]:
    """Director stats joined to the cleaned titles.

    Director credits are stored once, in parquet: both the stats and the choice of a
    first director read them, and the raw file is the largest input.
    """
    entries, n_entries = counted(reputation.director_entries(credits), "director_entries")
    tables.write_flat(entries, lake.path("director_entries"))
    entries = tables.read_table(spark, lake.path("director_entries"))
    stats, n_stats = counted(reputation.director_stats(entries, ratings), "directors")
    tables.write_flat(stats, lake.path("director_stats"))
    stats = tables.read_table(spark, lake.path("director_stats"))
    cleaned = tables.read_table(spark, lake.path("cleaned"))
    enriched, n_enriched = counted(
        reputation.with_directors(cleaned, reputation.primary_director(entries), stats),
        "enriched",
    )
    tables.write_flat(enriched, lake.path("director_features"))
    return {
        "director_entries": n_entries.get["rows"], "directors": n_stats.get["rows"],
        "enriched": n_enriched.get["rows"],
    }


def store_training(spark: SparkSession, lake: Lake) -> EqualWidthBins:
    """The 43-feature matrix, split into train and test; returns the bins it used."""
    enriched = tables.read_table(spark, lake.path("director_features"))
    features = tables.read_table(spark, lake.path("features"))
    bins = EqualWidthBins.fit(features, "votes_log")
    full = matrix.training_matrix_in_one_pass(enriched, bins)
    tables.write_split(matrix.with_split(full), lake.path("training"))
    return bins


def store_models(spark: SparkSession, lake: Lake, bins: EqualWidthBins,
                 versions: Sequence[models.Version] = models.VERSIONS) -> DataFrame:
    """Fit the versions on the stored training data; their metrics, one row each.

    Stored are every model, a metrics record per version, the record of the best model, and
    the training data as CSV, train and test apart, for trainers elsewhere.
    """
    rows = tables.read_table(spark, lake.path("training"))
    tables.write_split_csv(rows, lake.path("training_csv"))
    for name, (model, metrics) in models.train_versions(versions, rows, bins).items():
        model.save(lake.path(f"models/{name}"))
        tables.write_record(metrics, lake.path(f"metrics/{name}"))
    found = stored_metrics(spark, lake, versions)
    tables.write_record(models.best_record(found), lake.path("metrics/best"))
    return found


def stored_metrics(spark: SparkSession, lake: Lake,
                   versions: Sequence[models.Version] = models.VERSIONS) -> DataFrame:
    """The metrics records of the versions, as one table."""
    paths = [lake.path(f"metrics/{v.name}") for v in versions]
    return spark.read.schema(models.METRICS).json(paths).orderBy("version")


def best_model(spark: SparkSession, lake: Lake) -> models.RatingModel:
    """The stored model that the record of the best names."""
    name = spark.read.json(lake.path("metrics/best")).first()["best_model"]
    return models.RatingModel.load(spark, lake.path(f"models/{name}"))


def answer(requests: DataFrame, model: models.RatingModel, column: str = "request") -> DataFrame:
    """The request rows with ``status_code`` and ``response``, accepted or refused."""
    own = requests.columns
    parsed = scoring.parse_requests(requests, column)
    scored = scoring.score_requests(scoring.accepted(parsed), model.transform, model.bins)
    answered = scoring.response_json(scored, column)
    refused = scoring.error_json(parsed)
    return answered.select(*own, "status_code", "response").unionByName(
        refused.select(*own, "status_code", "response"))


def run_all(spark: SparkSession, titles: str, ratings: str, credits: str, lake: Lake,
            partitions: int | None = None) -> tuple[dict[str, int], EqualWidthBins]:
    """All jobs in order, from the raw files to the training data.

    Two jobs need the ratings, so these are unpacked once and stored as a table. ``partitions``
    spreads the rows of a few large gzip files over as many tasks.
    """
    raw_titles, raw_ratings, raw_credits = read_raw(spark, titles, ratings, credits, partitions)
    tables.write_flat(cleaning.typed_ratings(raw_ratings), lake.path("ratings"))
    raw_ratings = tables.read_table(spark, lake.path("ratings"))
    counts = store_cleaned(raw_titles, raw_ratings, lake)
    counts |= store_features(spark, lake)
    counts |= store_directors(spark, raw_credits, raw_ratings, lake)
    return counts, store_training(spark, lake)
