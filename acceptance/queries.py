"""One query per operator, each over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance import analog
from marquee import vocabulary as V
from marquee.functions.bins import EqualWidthBins
from marquee.functions.features import log_votes
from marquee.operators import (
    cleaning, matrix, models, quality, reports, reputation, rollups, sampling, scoring, title_index, tokens,
    uncertainty,
)
from marquee.session import scratch_path
from marquee.sources import catalog, daily, quarantine, tables, tsv
from marquee.streaming import alarm_state, job_metrics, updates

Query = Callable[[SparkSession, str], DataFrame]

LOGS = ("votes_log", "votes_log_squared", "director_votes_log")


def rounded(df: DataFrame, columns: Sequence[str] = LOGS, digits: int = 9) -> DataFrame:
    """Cut off the last bits, in which two engines' logarithms and sums may differ."""
    return df.withColumns({c: F.round(c, digits) for c in columns if c in df.columns})


# --- relations the queries share ------------------------------------------

def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_titles(analog.titles(spark, sf_dir), analog.ratings(spark, sf_dir))


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reputation.director_entries(analog.credits(spark, sf_dir))


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reputation.director_stats(entries(spark, sf_dir), analog.ratings(spark, sf_dir))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    primary = reputation.primary_director(entries(spark, sf_dir))
    return reputation.with_directors(cleaned(spark, sf_dir), primary, stats(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.feature_matrix(cleaned(spark, sf_dir))


def vote_bins(spark: SparkSession, sf_dir: str) -> EqualWidthBins:
    votes = log_votes(F.col("numvotes")).alias("votes_log")
    return EqualWidthBins.fit(cleaned(spark, sf_dir).select(votes), "votes_log")


def full_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.training_matrix_in_one_pass(enriched(spark, sf_dir), vote_bins(spark, sf_dir))


def over(relation: Query, operator: Callable[..., DataFrame], *args) -> Query:
    """A query that applies an operator to a shared relation."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(relation(spark, sf_dir), *args)
    return query


def on_cleaned(operator: Callable[..., DataFrame], *args) -> Query:
    return over(cleaned, operator, *args)


def view(name: str) -> Query:
    """A catalog view over the cleaned table, which is stored once per session and folder."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        def make():
            path = scratch_path(spark, "warehouse")
            tables.write_cleaned(cleaned(spark, sf_dir), path)
            return path

        path = once(spark, sf_dir, "warehouse", make)
        catalog.register_stored(spark, path, "stored_cleaned")
        return spark.sql(f"SELECT * FROM {name}")
    return query


# --- features -------------------------------------------------------------

def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = features(spark, sf_dir)
    result = matrix.interaction_matrix(base, vote_bins(spark, sf_dir))
    return rounded(result.select(
        "tconst", *V.POPULARITY_FEATURES, *V.GENRE_PAIR_FEATURES
    ))


def equal_width_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = vote_bins(spark, sf_dir)
    return features(spark, sf_dir).select(
        "tconst", bins.index(F.col("votes_log")).cast("int").alias("bin")
    )


def merged_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(matrix.training_matrix(
        features(spark, sf_dir), enriched(spark, sf_dir), vote_bins(spark, sf_dir)
    ))


def right_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.right_closed_bands(cleaned(spark, sf_dir)).select(
        "tconst", "rating_tier", "runtime_bucket", "vote_tier"
    )


def feature_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the 43 features the base matrix lacks."""
    missing = tables.missing_columns(features(spark, sf_dir), V.FULL_FEATURES)
    base = features(spark, sf_dir).agg(F.count("*").alias("row_count"))
    return base.select("row_count", F.explode(F.array(*map(F.lit, missing))).alias("missing"))


def add_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interaction features added beside one that is there already, which stays."""
    base = features(spark, sf_dir).withColumn("popularity_score", F.lit(-1.0))
    return matrix.with_interactions(base, vote_bins(spark, sf_dir)).select(
        "tconst", "popularity_score", "long_drama", "votes_log_binned")


def split_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.with_split(cleaned(spark, sf_dir)).select("tconst", "split")


def reliable_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train and test rows alike: both carry the split column, so they are one table."""
    marked = matrix.with_split(features(spark, sf_dir))
    return matrix.reliable(marked).select("tconst", "target_rating", "split")


# --- counts ---------------------------------------------------------------

def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.stage_counts(
        analog.titles(spark, sf_dir), analog.ratings(spark, sf_dir), analog.credits(spark, sf_dir)
    )


def described_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality.describe(features(spark, sf_dir), "target_rating"), ("mean", "std"), 6)


def described_reliable(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = matrix.reliable(features(spark, sf_dir))
    return rounded(quality.describe(wanted, "target_rating"), ("mean", "std"), 6)


def recent_decades(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = cleaned(spark, sf_dir).filter(F.col("decade") >= 1980)
    return quality.value_counts(recent, "decade").orderBy("decade")


def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_n(cleaned(spark, sf_dir), 1000).select("tconst", "primarytitle")


# --- sources and sinks ----------------------------------------------------

def store_tsv(df: DataFrame, names: dict[str, str], path: str) -> None:
    """Write a raw file the way it is published: gzip, tabs, no quotes, ``\\N``."""
    raw = df.select([F.col(old).cast("string").alias(new) for old, new in names.items()])
    (raw.write.option("sep", "\t").option("header", True).option("nullValue", V.NULL_MARKER)
        .option("quote", "").option("emptyValue", "").option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False).option("compression", "gzip").csv(path))


def cleaned_from_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "raw")
    titles = {c.lower(): c for c in tsv.TITLE_COLUMNS if c != "endYear"}
    ratings = {c.lower(): c for c in tsv.RATING_COLUMNS}
    store_tsv(analog.titles(spark, sf_dir), titles, f"{base}/titles")
    store_tsv(analog.ratings(spark, sf_dir), ratings, f"{base}/ratings")
    return cleaning.clean_titles(
        tsv.read_tsv(spark, f"{base}/titles", list(titles.values())),
        tsv.read_tsv(spark, f"{base}/ratings", list(ratings.values())),
    )


def cleaned_by_decade(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "cleaned")
    tables.write_cleaned(cleaned(spark, sf_dir), path)
    return tables.read_table(spark, path).select(V.CLEANED_COLUMNS)


def bucketed(df: DataFrame, label: str) -> DataFrame:
    return tables.materialize_bucketed(df, label, "tconst")


def cleaned_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaning from tables dealt out by title: the join shuffles nothing."""
    return cleaning.clean_titles(bucketed(analog.titles(spark, sf_dir), "titles"),
                                 bucketed(analog.ratings(spark, sf_dir), "ratings"))


def stats_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reputation.director_stats(bucketed(entries(spark, sf_dir), "entries"),
                                             bucketed(analog.ratings(spark, sf_dir), "ratings")))


def matrix_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(matrix.training_matrix(bucketed(features(spark, sf_dir), "features"),
                                          bucketed(enriched(spark, sf_dir), "enriched"), vote_bins(spark, sf_dir)))


def changed_since(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """What a first run had, some titles under another year, and what a second one brings."""
    now, part = cleaned(spark, sf_dir), F.pmod(F.xxhash64("tconst"), F.lit(10))
    moved = now.filter(part < 2).withColumns(
        {"startyear": F.col("startyear") - 10, "decade": F.col("decade") - 10, "numvotes": F.col("numvotes") + 1})
    return now.filter(part.between(2, 7)).unionByName(moved), now.filter((part < 2) | (part > 7))


def daily_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, (before, changed) = scratch_path(spark, "daily"), changed_since(spark, sf_dir)
    tables.write_cleaned(before, path)
    daily.merge_cleaned(spark, path, changed)
    return tables.read_table(spark, path).select(V.CLEANED_COLUMNS)


def loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial rows of five loads, stored one after the other."""
    path, rows = scratch_path(spark, "partials"), cleaned(spark, sf_dir)
    for load in range(5):
        rollups.partials(rows.filter(F.pmod(F.xxhash64("tconst"), F.lit(5)) == load)).write.mode("append").parquet(path)
    return tables.read_table(spark, path)


def rollup_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct counts, and whether the merged sketches come within four standard errors."""
    exact = cleaned(spark, sf_dir).groupBy("decade").agg(
        F.count_distinct("tconst").alias("titles"), F.count_distinct("genres").alias("genres"))
    found = rollups.distinct_counts(loads(spark, sf_dir))

    def near(a: str, b: str) -> Column:
        return F.abs(F.col(a) - F.col(b)) <= F.greatest(F.lit(1.0), 4 * rollups.SKETCH_ERROR * F.col(b))

    return exact.join(found, "decade").select(
        "decade", "titles", "genres",
        (near("distinct_titles", "titles") & near("distinct_genres", "genres")).alias("near"))


def rollup_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, metrics = scratch_path(spark, "days"), analog.job_metrics(spark, sf_dir)
    for load in range(3):
        rollups.job_partials(metrics.filter(F.pmod(F.xxhash64("ts"), F.lit(3)) == load)).write.mode("append").parquet(path)
    return rounded(rollups.daily_average(tables.read_table(spark, path)), ("avg_elapsed",), 6)


def checked_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title lines, some of them broken: a field too few, a year or a runtime that is no number."""
    path, key = scratch_path(spark, "lines"), F.col("tconst")
    named = {c.lower(): c for c in tsv.TITLE_COLUMNS}
    fields = [F.coalesce(F.col(c).cast("string"), F.lit(V.NULL_MARKER)) if c in analog.titles(spark, sf_dir).columns
              else F.lit(V.NULL_MARKER) for c in named]
    at = {c: k for k, c in enumerate(named)}
    fields[at["startyear"]] = F.when(key % 13 == 0, "19x5").otherwise(fields[at["startyear"]])
    fields[at["runtimeminutes"]] = F.when(key % 17 == 0, "long").otherwise(fields[at["runtimeminutes"]])
    line = F.concat_ws("\t", *fields[:-1], F.when(key % 19 != 0, fields[-1]))
    analog.titles(spark, sf_dir).select(line.alias("value")).write.text(path)
    return quarantine.checked_lines(spark, path, tsv.TITLE_COLUMNS, quarantine.TITLE_NUMBERS)


def refused_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine.reason_counts(checked_titles(spark, sf_dir))


def refused_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines were read, and how many of them are sound, refused and stored."""
    checked, path = checked_titles(spark, sf_dir), scratch_path(spark, "refused")
    taken = quarantine.take_in(checked, tsv.TITLE_COLUMNS, path, most_refused=1.0)
    return checked.agg(F.count("*").alias("lines")).join(taken.agg(F.count("*").alias("sound"))).join(
        tables.read_table(spark, path).agg(F.count("*").alias("refused")))


def features_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "features")
    tables.write_flat(features(spark, sf_dir), path)
    return rounded(tables.read_table(spark, path))


def split_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "split")
    tables.write_split(matrix.with_split(features(spark, sf_dir)), path)
    return tables.read_table(spark, path).select("tconst", "split")


def merged_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train rows with, test rows without the interaction features, read as one table."""
    path = scratch_path(spark, "merged")
    marked = matrix.with_split(features(spark, sf_dir))
    wide = matrix.with_interactions(marked, vote_bins(spark, sf_dir))
    tables.write_flat(wide.filter(F.col("split") == "train"), f"{path}/part=wide")
    tables.write_flat(marked.filter(F.col("split") == "test"), f"{path}/part=narrow")
    return tables.read_table(spark, path, merge=True).select(
        "tconst", "part", "long_drama", "popularity_score"
    )


def training_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    exported = rounded(full_matrix(spark, sf_dir))
    tables.write_training_csv(exported, path)
    schema = ", ".join(f"{c} double" for c in ["target_rating", *V.FULL_FEATURES])
    return spark.read.schema(schema).csv(path)


# Text that a careless CSV would change.
NOTE = """CASE tconst % 7 WHEN 0 THEN '  lead' WHEN 1 THEN 'trail  ' WHEN 2 THEN '' WHEN 3 THEN
  'line\nbreak' WHEN 4 THEN 'a "quote", a comma' WHEN 5 THEN 'back\\\\slash' END"""


def sample_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "sample")
    chosen = sampling.sample_n(cleaned(spark, sf_dir), 1000).withColumn("note", F.expr(NOTE))
    tables.write_sample_csv(chosen, path)
    return tables.read_sample_csv(spark, path, chosen.schema)


# --- models ---------------------------------------------------------------

def baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The director's average as the prediction, on the test rows."""
    test = matrix.with_split(full_matrix(spark, sf_dir)).filter(F.col("split") == "test")
    return test.withColumn("prediction", F.col("director_avg_rating"))


def baseline_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = models.regression_metrics(baseline(spark, sf_dir))
    return rounded(metrics, ("rmse", "r2", "mae"), 6)


def metrics_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "metrics")
    metrics = baseline_metrics(spark, sf_dir)
    tables.write_record(metrics, path)
    return spark.read.schema(metrics.schema).json(path)


# What a session has stored or fitted for a folder of tables: kept by application and folder.
_kept: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, sf_dir: str, label: str, make: Callable[[], object]):
    """What ``make`` gives, made once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def stored_matrix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, EqualWidthBins]:
    def make():
        # the bins' titles and the matrix's, with what the matrix is made of
        titles = tables.materialize(enriched(spark, sf_dir).select(matrix.MATRIX_INPUTS), "enriched")
        bins = EqualWidthBins.fit(titles.select(log_votes(F.col("numvotes")).alias("votes_log")), "votes_log")
        full = matrix.training_matrix_in_one_pass(titles, bins)
        path = scratch_path(spark, "training")
        tables.write_split(matrix.with_split(full), path)
        return path, bins

    path, bins = once(spark, sf_dir, "training", make)
    return tables.read_table(spark, path), bins


def fitted_paths(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> dict[str, str]:
    """Where versions are stored, fitted at their published settings, all in one go.

    A version is fitted once per session and folder; its model and metrics are stored in the
    shared folder, and the queries load them.
    """
    rows, bins = stored_matrix(spark, sf_dir)
    application = spark.sparkContext.applicationId
    missing = [v for v in models.VERSIONS if v.name in names and (application, sf_dir, v.name) not in _kept]
    for name, (model, metrics) in models.train_versions(missing, rows, bins).items() if missing else ():
        path = scratch_path(spark, name)
        model.save(f"{path}/model")
        tables.write_record(metrics, f"{path}/metrics")
        _kept[application, sf_dir, name] = path
    return {name: _kept[application, sf_dir, name] for name in names}


def stored_metrics(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    return [spark.read.schema(models.METRICS).json(f"{path}/metrics") for path in paths]


def fitted(spark: SparkSession, sf_dir: str,
           name: str = "v4-full") -> tuple[models.RatingModel, DataFrame, DataFrame]:
    """A fitted version, its metrics, and all rows."""
    path = fitted_paths(spark, sf_dir, (name,))[name]
    rows, _ = stored_matrix(spark, sf_dir)
    return models.RatingModel.load(spark, f"{path}/model"), stored_metrics(spark, [path])[0], rows


def test_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("split") == "test")


def is_finite(name: str) -> Column:
    return F.col(name).isNotNull() & ~F.isnan(name) & (F.abs(name) != float("inf"))


def fit_facts(metrics: DataFrame) -> DataFrame:
    """What is known of a fit beforehand, and whether its scores are numbers in range."""
    sound = is_finite("rmse") & is_finite("r2") & is_finite("mae") & (F.col("r2") <= 1) & (
        F.col("mae") >= 0) & (F.col("mae") <= F.col("rmse"))
    return metrics.select("version", "population", "n_features", "rounds", "train_rows",
                          "test_rows", sound.alias("sound"))


def prediction_facts(predicted: DataFrame) -> DataFrame:
    """Titles and actual ratings, and whether the error follows from the prediction."""
    agrees = is_finite("predicted") & (F.col("error") == F.abs(F.col("actual") - F.col("predicted")))
    return predicted.select("tconst", "primarytitle", "actual", agrees.alias("agrees"))


def model_fit(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fit_facts(fitted(spark, sf_dir, name)[1])
    return query


def model_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many features have an importance, whether they are in order, and their sum."""
    model = fitted(spark, sf_dir)[0]
    every, top = models.importances(model), models.importances(model, 10)
    listed = top.agg(F.collect_list("importance").alias("listed"))
    ordered = (F.sort_array("listed", asc=False) == F.col("listed")).alias("ordered")
    return every.agg(F.count_distinct("feature").alias("n_features"),
                     F.round(F.sum("importance"), 6).alias("total")).join(
        listed.select(F.size("listed").alias("n_top"), ordered))


def model_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _, rows = fitted(spark, sf_dir)
    return prediction_facts(models.predictions(model, test_rows(rows)))


def model_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _, rows = fitted(spark, sf_dir)
    return prediction_facts(models.sample_predictions(model, test_rows(rows)))


def model_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rounds of a fit, and whether each has an error on the test rows."""
    model, _, rows = fitted(spark, sf_dir)
    curve = models.learning_curve(model, test_rows(rows))
    return curve.select("round", (is_finite("rmse") & (F.col("rmse") > 0)).alias("sound"))


def model_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test predictions of one tree with one split on the genre flags, all rows and columns used."""
    rows, bins = stored_matrix(spark, sf_dir)
    plain = models.Boosting(rounds=1, depth=1, rate=1.0, row_share=1.0, column_share=1.0, l2=0.0)
    model = models.fit(rows.filter(F.col("split") == "train"), V.GENRE_FLAGS, bins, plain)
    predicted = models.predictions(model, test_rows(rows))
    return predicted.select("tconst", F.round("predicted", 6).alias("predicted"))


def model_trees(settings: models.Boosting) -> Query:
    """Test predictions of a few trees in full, all rows and columns used."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows, bins = stored_matrix(spark, sf_dir)
        model = models.fit(rows.filter(F.col("split") == "train"), V.PLAIN_FEATURES, bins, settings)
        predicted = models.predictions(model, test_rows(rows))
        return predicted.select("tconst", F.round("predicted", 6).alias("predicted"))
    return query


# Texts to look for: rare, common, too short for the index, absent, with a common part.
WANTED = ["le 142", "Title", "42", "Nowhere", "Title 7"]


def search_by_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, titles = scratch_path(spark, "trigrams"), analog.titles(spark, sf_dir)
    title_index.write_index(titles, path)
    found = [title_index.search(spark, path, titles, text).withColumn("text", F.lit(text)) for text in WANTED]
    return reduce(DataFrame.unionByName, found)


def genre_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names a title has of the 12 most frequent, and how many others."""
    rows, path = cleaned(spark, sf_dir), scratch_path(spark, "genres")
    tokens.GenreTokens.fit(rows, 12).save(path)
    genres = tokens.GenreTokens.load(spark, path)
    return genres.transform(rows).select("tconst", F.array_join(genres.names(), ",").alias("known"), "unknown_genres")


def genre_token_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flags as tokens give them, where the vocabulary is that of the flags."""
    vectors = tokens.GenreTokens(V.GENRES).transform(cleaned(spark, sf_dir))
    places = vectors.withColumn("_a", vector_to_array("genre_vector"))
    return places.select("tconst", *[F.col("_a")[k].cast("int").alias(f) for k, f in enumerate(V.GENRE_FLAGS)])


def model_uncertainty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fixed predictions compared: the director's average, and a step by votes."""
    test = matrix.with_split(full_matrix(spark, sf_dir)).filter(F.col("split") == "test")
    step = test.withColumn("step", F.lit(5.0) + F.col("is_well_known") / 2)
    found = uncertainty.paired_bootstrap(step, models.LABEL, "director_avg_rating", "step")
    return rounded(found, ("first_r2", "second_r2", "gain", "low", "high", "share_above"), 6)


def model_reloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many test rows a stored and reloaded model predicts differently: none."""
    model, _, rows = fitted(spark, sf_dir)
    path = scratch_path(spark, "model")
    model.save(path)
    again = models.RatingModel.load(spark, path)
    test = test_rows(rows)
    both = models.predictions(model, test).select("tconst", "predicted").join(
        models.predictions(again, test).select("tconst", F.col("predicted").alias("reloaded")),
        "tconst")
    return both.agg(
        F.count("*").alias("test_rows"),
        F.count_if(~F.col("predicted").eqNullSafe(F.col("reloaded"))).alias("differing_rows"),
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = fitted_paths(spark, sf_dir, tuple(v.name for v in models.VERSIONS))
    return models.history(stored_metrics(spark, list(paths.values())))


def model_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_facts(history(spark, sf_dir))


def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the version chosen has the highest R² of those on all titles."""
    every = history(spark, sf_dir).filter(F.col("population") == "all")
    most = every.agg(F.count("*").alias("versions"), F.max("r2").alias("most"))
    return models.best_version(every).join(most).select(
        "population", "versions", (F.col("r2") == F.col("most")).alias("is_best"))


def best_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the record of the best model agrees with itself."""
    record = models.best_record(history(spark, sf_dir))
    both = F.greatest("full_dataset_r2", "filtered_dataset_r2")
    named = F.when(F.col("filtered_dataset_r2") > F.col("full_dataset_r2"), "v4-filtered").otherwise("v4-full")
    gain = F.col("improvement_over_first") == F.col("r2") - F.col("first_r2")
    return record.select("n_features", ((F.col("r2") == both) & (F.col("best_model") == named) & gain).alias("agrees"))


# --- scoring --------------------------------------------------------------

def simple_predictor(df: DataFrame) -> DataFrame:
    """Stands in for a model where the result is to be checked; leaves the 1 to 10 range."""
    return df.withColumn(
        "prediction", F.col("director_avg_rating") * 1.25 - 1.5 + 0.5 * F.col("is_well_known")
    )


def request_features(variant: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        bins = vote_bins(spark, sf_dir) if variant == "training" else None
        wanted = scoring.accepted(scoring.validate(analog.requests(spark, sf_dir)))
        result = scoring.score_features(wanted, bins, variant)
        return rounded(result.select("request_id", *V.FULL_FEATURES))
    return query


def score_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = scoring.parse_requests(analog.request_json(spark, sf_dir))
    return scoring.error_json(parsed).select("request_id", "error", "status_code", "response")


def score_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = scoring.accepted(scoring.validate(analog.requests(spark, sf_dir)))
    scored = scoring.score_requests(wanted, simple_predictor, variant="service")
    return scoring.scoring_error(scored).withColumn("error", F.round("error", 6))


def score_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = scoring.accepted(scoring.parse_requests(analog.request_json(spark, sf_dir)))
    scored = scoring.score_requests(wanted, simple_predictor, variant="service")
    return scoring.response_json(scored).select("request_id", "status_code", "response")


def score_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests rated by the fitted model, and whether each response agrees with itself."""
    model = fitted(spark, sf_dir)[0]
    wanted = scoring.accepted(scoring.validate(analog.requests(spark, sf_dir)))
    scored = scoring.scoring_error(scoring.score_requests(wanted, model.transform, model.bins))
    rating = F.col("predicted_rating")
    tier = F.when(rating < 5, "poor").when(rating < 7, "average").when(rating < 8, "good").otherwise("excellent")
    agrees = rating.between(1, 10) & (F.col("is_high_rated") == (rating >= 7)) & (
        F.col("confidence_tier") == tier) & F.col("error").eqNullSafe(F.abs(F.col("actual") - rating))
    return scored.select("request_id", "genres", "year", "actual", agrees.alias("agrees"))


def score_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The client variant does not keep ratings from 1 to 10."""
    wanted = scoring.accepted(scoring.validate(analog.requests(spark, sf_dir)))
    scored = scoring.score_requests(wanted, simple_predictor, variant="client")
    return scored.select("request_id", "predicted_rating", "is_high_rated", "confidence_tier")


def model_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many requests a model rates differently on a stream than in a batch: none."""
    model = fitted(spark, sf_dir)[0]

    def rated(source: Query) -> DataFrame:
        wanted = scoring.accepted(scoring.validate(source(spark, sf_dir)))
        scored = scoring.score_requests(wanted, model.transform, model.bins)
        return scored.select("request_id", "predicted_rating", "confidence_tier")

    batch = rated(analog.requests)
    streamed = updates.run_rows(rated(analog.request_stream), "rated")
    both = batch.join(streamed.select("request_id", F.struct(
        "predicted_rating", "confidence_tier").alias("streamed")), "request_id")
    same = F.struct("predicted_rating", "confidence_tier").eqNullSafe(F.col("streamed"))
    return both.agg(
        F.count("*").alias("requests"), F.count_if(~same).alias("differing_rows")
    )


def score_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = scoring.accepted(scoring.validate(analog.request_stream(spark, sf_dir)))
    scored = scoring.score_requests(wanted, simple_predictor, variant="service")
    result = scoring.scoring_error(scored).withColumn("error", F.round("error", 6))
    return updates.run_rows(result, "scored")


def directed_features(requests: DataFrame, stats_table: DataFrame) -> DataFrame:
    looked_up = scoring.look_up_directors(scoring.accepted(scoring.validate(requests)), stats_table)
    return rounded(scoring.score_features(looked_up, variant="service").select("request_id", *V.DIRECTOR_FEATURES))


def score_directors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return directed_features(analog.directed_requests(spark, sf_dir), stats(spark, sf_dir))


def score_directors_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a stream, the stats read anew for every micro-batch."""
    path = scratch_path(spark, "stats")
    tables.write_flat(stats(spark, sf_dir), path)
    stream = analog.directed_request_stream(spark, sf_dir)
    return updates.run_rows(stream, "directed", lambda batch: directed_features(batch, tables.read_table(spark, path)))


def before_columns(df: DataFrame) -> DataFrame:
    return rounded(df.select("tconst", *V.DIRECTOR_FEATURES))


def directors_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = reputation.rated_titles(entries(spark, sf_dir), analog.ratings(spark, sf_dir))
    sums = reputation.yearly_sums(rated, cleaning.typed_titles(analog.titles(spark, sf_dir)))
    primary = reputation.primary_director(entries(spark, sf_dir))
    return before_columns(reputation.with_directors_before(
        cleaned(spark, sf_dir), primary, reputation.stats_before(sums)))


def directors_of_others(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = reputation.rated_titles(entries(spark, sf_dir), analog.ratings(spark, sf_dir))
    primary = reputation.primary_director(entries(spark, sf_dir))
    return before_columns(reputation.with_other_titles(
        cleaned(spark, sf_dir), primary, reputation.director_sums(rated)))


# --- job metrics ----------------------------------------------------------

def metric_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job_metrics.task_sums(analog.job_metrics(spark, sf_dir))


def metric_sums_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = analog.job_metrics_stream(spark, sf_dir).withWatermark("ts", "10 minutes")
    return updates.run_updates(job_metrics.task_sums(stream), ("window_start", "job"), "sums")


def metric_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = job_metrics.elapsed_average(analog.job_metrics(spark, sf_dir))
    return rounded(result, ("avg_elapsed",), 6)


def metric_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = job_metrics.daily_average(analog.job_metrics(spark, sf_dir))
    return rounded(result, ("avg_elapsed",), 6)


def metric_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job_metrics.alarms(metric_sums(spark, sf_dir))


def metric_alarms_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alarms raised within the stream, by the batch in which a window first fails."""
    stream = analog.job_metrics_stream(spark, sf_dir).withWatermark("ts", "10 minutes")
    raised = job_metrics.alarms(job_metrics.task_sums(stream))
    return updates.run_updates(raised, ("window_start", "job"), "alarms")


def replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored job metrics as a stream of several files, a micro-batch for each."""
    path = scratch_path(spark, "replay")
    metrics = analog.job_metrics(spark, sf_dir)
    metrics.repartition(4).write.parquet(path)
    stream = spark.readStream.schema(metrics.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return stream.withWatermark("ts", updates.disorder(metrics))


def metric_sums_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = job_metrics.task_sums(replayed(spark, sf_dir))
    return updates.run_updates(sums, ("window_start", "job"), "batches")


def metric_sums_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums over events whose files all come twice, counted once each on a stream."""
    path = scratch_path(spark, "twice")
    events = analog.job_events(spark, sf_dir)
    for _ in range(2):
        events.repartition(3).write.mode("append").parquet(path)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)
    timely = stream.withWatermark("ts", updates.disorder(events))
    return job_metrics.task_sums(updates.run_rows(job_metrics.counted_once(timely, "event_id"), "once"))


# An alarm is cleared after as many seconds without failures; a stream's watermark stays as far behind.
QUIET, DELAY = 1800, 600


def alarm_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = analog.job_metrics(spark, sf_dir)
    return alarm_state.transitions(metrics, QUIET, alarm_state.closed_until(metrics, DELAY))


def alarm_transitions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = analog.job_metrics_stream(spark, sf_dir).withWatermark("ts", f"{DELAY} seconds")
    return updates.run_rows(alarm_state.transitions_stream(stream, QUIET), "transitions")


QUERIES: dict[str, Query] = {
    # titles
    "etl_clean": cleaned,
    "band_right_closed": right_closed,
    "title_search": over(analog.titles, reports.title_search, "42"),
    # reports, panels and views
    "rpt_movies_per_decade": on_cleaned(reports.movies_per_decade),
    "rpt_tier_share": on_cleaned(reports.tier_share),
    "rpt_top_movies": on_cleaned(reports.top_movies),
    "rpt_best_genres": on_cleaned(reports.best_genres),
    "rpt_tier_trend": on_cleaned(reports.tier_trend),
    "rpt_runtime_effect": on_cleaned(reports.runtime_effect),
    "panel_totals": on_cleaned(reports.panel_totals),
    "panel_decade_count": on_cleaned(reports.panel_decade_count),
    "panel_decade_rating": on_cleaned(reports.panel_decade_rating),
    "panel_genres": on_cleaned(reports.panel_genres),
    "panel_rating_tier": on_cleaned(reports.panel_tiers, "rating_tier"),
    "panel_vote_tier": on_cleaned(reports.panel_tiers, "vote_tier"),
    "v_decade_stats": view("v_decade_stats"),
    "v_genre_stats": view("v_genre_stats"),
    "v_movies_summary": view("v_movies_summary"),
    "v_top_movies": view("v_top_movies"),
    "top_by_votes": on_cleaned(reports.top_by_votes),
    # quality and counts
    "dq_completeness": on_cleaned(quality.dq_completeness),
    "dq_health": on_cleaned(quality.dq_health),
    "dq_by_decade": on_cleaned(quality.dq_by_decade),
    "stage_counts": stage_counts,
    "value_counts": on_cleaned(quality.value_counts, "rating_tier"),
    "value_counts_recent": recent_decades,
    "describe_target": described_target,
    "describe_reliable": described_reliable,
    "genre_flag_totals": over(features, quality.flag_totals),
    "flag_counts": over(enriched, quality.flag_counts),
    # directors
    "director_entries": entries,
    "director_stats": over(stats, rounded),
    "primary_director": over(entries, reputation.primary_director),
    "director_enriched": over(enriched, rounded),
    "director_before": directors_before,
    "director_of_others": directors_of_others,
    # features
    "feature_matrix": over(features, rounded),
    "interaction_features": interactions,
    "equal_width_bins": equal_width_bins,
    "training_matrix": merged_matrix,
    "training_matrix_one_pass": over(full_matrix, rounded),
    "feature_audit": feature_audit,
    "add_if_absent": add_if_absent,
    "train_test_split": split_titles,
    "reliable_subset": reliable_titles,
    "sample_n": sample,
    # sources and sinks
    "source_tsv": cleaned_from_tsv,
    "sink_cleaned_by_decade": cleaned_by_decade,
    "sink_daily": daily_runs,
    "etl_clean_bucketed": cleaned_bucketed,
    "director_stats_bucketed": stats_bucketed,
    "training_matrix_bucketed": matrix_bucketed,
    "rollup_decade_stats": lambda spark, sf_dir: rollups.decade_stats(loads(spark, sf_dir)),
    "rollup_movies_per_decade": lambda spark, sf_dir: rollups.movies_per_decade(loads(spark, sf_dir)),
    "rollup_health": lambda spark, sf_dir: rollups.health(loads(spark, sf_dir)),
    "rollup_distinct": rollup_distinct,
    "rollup_daily": rollup_days,
    "source_refused": refused_counts,
    "source_refused_lines": refused_lines,
    "sink_features": features_flat,
    "sink_split": split_folders,
    "source_merged_schemas": merged_schemas,
    "sink_training_csv": training_csv,
    "sink_sample_csv": sample_csv,
    "sink_metrics_json": metrics_record,
    # models
    "regression_metrics": baseline_metrics,
    "model_fit": model_fit("v4-full"),
    "model_fit_v1": model_fit("v1"),
    "model_fit_v2": model_fit("v2"),
    "model_fit_v3": model_fit("v3"),
    "model_fit_v4_filtered": model_fit("v4-filtered"),
    "model_importance": model_importance,
    "model_predictions": model_predictions,
    "model_sample": model_sample,
    "model_reloaded": model_reloaded,
    "model_uncertainty": model_uncertainty,
    "title_search_index": search_by_index,
    "genre_tokens": genre_tokens,
    "genre_token_flags": genre_token_flags,
    "model_history": model_history,
    "model_best": best_model,
    "model_record": best_record,
    "model_curve": model_curve,
    "model_stump": model_stump,
    "model_one_tree": model_trees(models.Boosting(
        rounds=1, depth=3, rate=1.0, row_share=1.0, column_share=1.0, min_gain_total=0.01)),
    "model_two_trees": model_trees(models.Boosting(
        rounds=2, depth=3, rate=0.5, row_share=1.0, column_share=1.0, min_rows=5, min_gain_total=0.1, l1=2.5)),
    # scoring
    "score_features": request_features("training"),
    "score_features_service": request_features("service"),
    "score_features_client": request_features("client"),
    "score_rejects": score_rejects,
    "score_error": score_simple,
    "score_json": score_json,
    "score_client": score_client,
    "score_requests": score_requests,
    "score_error_stream": score_stream,
    "score_requests_stream": model_stream,
    "score_directors": score_directors,
    "score_directors_stream": score_directors_stream,
    # job metrics
    "metric_sum_5m": metric_sums,
    "metric_sum_5m_stream": metric_sums_stream,
    "metric_sum_5m_batches": metric_sums_batches,
    "metric_avg_5m": metric_average,
    "metric_avg_daily": metric_daily,
    "metric_alarms": metric_alarms,
    "metric_alarms_stream": metric_alarms_stream,
    "metric_sum_5m_once": metric_sums_once,
    "metric_alarm_transitions": alarm_transitions,
    "metric_alarm_transitions_stream": alarm_transitions_stream,
}
