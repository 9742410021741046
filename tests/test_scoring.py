import json
import math

import pytest
from pyspark.sql import functions as F
from rows import by_key, credits, ratings, titles

from marquee import vocabulary as V
from marquee.functions.bins import EqualWidthBins
from marquee.operators import cleaning, matrix, reputation, scoring
from marquee.streaming import updates

BINS = EqualWidthBins(math.log(11), math.log(500000))
SAMPLES = [
    ("Action,Crime,Drama", 2008, 152, 2800000, 8.4, 0.9, 9.0),
    ("Drama,Romance", 2004, 123, 600000, 6.8, 0.5, 7.8),
    ("Action,Adventure,Sci-Fi", 2007, 144, 750000, 6.5, 0.4, 7.0),
    ("Horror", 2007, 86, 200000, 5.8, 0.3, 6.3),
    ("Biography,Drama,History", 1993, 195, 1400000, 8.2, 0.85, 9.0),
    ("Drama", 2023, 105, 500, 6.0, 0.3, None),
]


@pytest.fixture(scope="module")
def samples(spark):
    return spark.createDataFrame(
        SAMPLES, "genres string, year int, runtime int, num_votes int, "
        "director_avg_rating double, director_hit_rate double, actual double")


def predictor(df):
    return df.withColumn("prediction", F.col("director_avg_rating") + 2.0)


NUMBERS = ["year_normalized", "runtime_normalized", "votes_log", "votes_normalized",
           "votes_log_binned", "director_avg_rating", "director_hit_rate", "director_max_rating"]
# per sample: the flags that are set, and the values of NUMBERS
WANTED = [
    ("genre_action genre_crime genre_drama is_modern decade_2000s is_epic is_well_known "
     "is_blockbuster is_drama_or_biography long_drama",
     [0.870968, 0.844444, 14.845130, 1.0, 9.0, 8.4, 0.9, 9.4]),
    ("genre_drama genre_romance is_modern decade_2000s is_well_known is_blockbuster "
     "is_drama_or_biography",
     [0.838710, 0.683333, 13.304687, 1.0, 9.0, 6.8, 0.5, 7.8]),
    ("genre_action genre_adventure genre_sci_fi is_modern decade_2000s is_well_known "
     "is_blockbuster is_action_adventure",
     [0.862903, 0.8, 13.527830, 1.0, 9.0, 6.5, 0.4, 7.5]),
    ("genre_horror is_modern decade_2000s is_well_known is_blockbuster is_horror_thriller",
     [0.862903, 0.477778, 12.206078, 1.0, 9.0, 5.8, 0.3, 6.8]),
    ("genre_drama genre_biography is_epic is_well_known is_blockbuster is_drama_or_biography "
     "long_drama",
     [0.75, 1.0, 14.151984, 1.0, 9.0, 8.2, 0.85, 9.2]),
    ("genre_drama is_modern decade_2020s is_drama_or_biography",
     [0.991935, 0.583333, 6.216606, 0.005, 6.0, 6.0, 0.3, 7.0]),
]
FLAGS = [c for c in V.INTERACTION_FEATURES if c not in (*NUMBERS, *V.POPULARITY_FEATURES)]


@pytest.mark.parametrize("variant, popularity", [
    ("service", [5, 5, 5, 5, 5, 0]), ("client", [6, 6, 6, 6, 6, 0])])
def test_sample_requests_get_the_published_features(samples, variant, popularity):
    rows = scoring.score_features(samples, variant=variant).collect()
    for row, (flags, numbers), score in zip(rows, WANTED, popularity):
        assert {c for c in FLAGS if row[c]} == set(flags.split())
        assert [row[c] for c in NUMBERS] == pytest.approx(numbers, abs=1e-6)
        assert row.popularity_score == score
        assert row.votes_log_squared == pytest.approx(row.votes_log ** 2)
        assert (row.director_movie_count, row.has_known_director) == (10, 1)
        assert row.director_votes_log == pytest.approx(13.122365, abs=1e-6)


@pytest.mark.parametrize("variant, average, hits", [("service", 6.0, 0.3), ("client", 6.5, 0.4)])
def test_defaults_fill_what_a_request_leaves_out(spark, variant, average, hits):
    bare = spark.createDataFrame([("Drama",)], "genres string")
    row = scoring.score_features(bare, variant=variant).first()
    assert (row.director_avg_rating, row.director_hit_rate) == (average, hits)
    assert (row.is_modern, row.is_well_known) == (1, 0)
    assert row.runtime_normalized == 95 / 180 and row.votes_log == pytest.approx(math.log(1001))


def test_requests_and_titles_get_the_same_features(spark):
    cleaned = cleaning.clean_titles(titles(spark), ratings(spark)).filter("genres IS NOT NULL")
    entries = reputation.director_entries(credits(spark))
    enriched = reputation.with_directors(
        cleaned, reputation.primary_director(entries),
        reputation.director_stats(entries, ratings(spark)))
    bins = EqualWidthBins.fit(matrix.feature_matrix(cleaned), "votes_log")
    trained = by_key(matrix.training_matrix_in_one_pass(enriched, bins))
    requests = cleaned.selectExpr(
        "tconst", "genres", "startyear AS year", "runtimeminutes AS runtime",
        "numvotes AS num_votes")
    scored = by_key(scoring.score_features(requests, bins))
    for key, row in trained.items():
        for column in V.INTERACTION_FEATURES:
            assert scored[key][column] == row[column], (key, column)


def test_variants_are_checked(samples):
    with pytest.raises(ValueError):
        scoring.score_features(samples, variant="other")
    with pytest.raises(ValueError):
        scoring.score_features(samples)


def test_ratings_stay_within_bounds_and_get_tiers(spark):
    df = spark.createDataFrame(
        [(-3.0,), (4.999,), (5.0,), (6.996,), (7.994,), (11.0,)], "prediction double")
    rows = scoring.with_response(df).collect()
    assert [r.predicted_rating for r in rows] == [1.0, 5.0, 5.0, 7.0, 7.99, 10.0]
    assert [r.confidence_tier for r in rows] == [
        "poor", "average", "average", "good", "good", "excellent"]
    assert [r.is_high_rated for r in rows] == [False, False, False, True, True, True]


def test_the_client_variant_leaves_ratings_unbounded(spark):
    df = spark.createDataFrame([(-3.004,), (11.5,)], "prediction double")
    assert [r.predicted_rating for r in scoring.with_response(df, "client").collect()] == [-3.0, 11.5]


def test_error_is_null_without_an_actual_rating(samples):
    rows = scoring.scoring_error(scoring.score_requests(samples, predictor, BINS)).collect()
    assert rows[0].error == pytest.approx(1.0) and rows[-1].error is None


def test_own_columns_come_back_unchanged(spark):
    df = spark.createDataFrame([("Drama", None, "x")],
                               "genres string, director_avg_rating double, note string")
    row = scoring.score_requests(df, predictor, BINS).first()
    assert row.director_avg_rating is None and row.note == "x" and row.predicted_rating == 8.0


TEXTS = [
    ('{"genres":"Drama","year":2008,"num_votes":"500"}', None),
    ('{"year":2008}', "genres field required"),
    ('{"genres":null}', "genres cannot be read"),
    ('{"year":"soon"}', "genres field required"),
    ('{"genres":"Drama","year":"soon"}', "year cannot be read"),
    ('{"genres":"Drama","director_avg_rating":"high"}', "director_avg_rating cannot be read"),
    ('{"genres":"Drama"', "request is not valid JSON"),
    ("", "request is not valid JSON"),
    ("[1]", "request is not valid JSON"),
    ('{"genres":"","runtime":90.7}', None),
    ('{"genres":"Drama"} xyz', "request is not valid JSON"),
    ('{"genres":"Drama","genres":"Comedy"}', "request is not valid JSON"),
    ('{"genres":"Drama","year":"90.7"}', "year cannot be read"),
    ('{"genres":"Drama","num_votes":null}', "num_votes cannot be read"),
    ('{"genres":5}', "genres cannot be read"),
    (None, "request is not valid JSON"),
    ('  { "genres" : "War" , "director_hit_rate" : "0.5" }  ', None),
    ("{}", "genres field required"),
]


def test_requests_are_parsed_and_refused(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TEXTS)], "id int, request string")
    parsed = by_key(scoring.parse_requests(df), "id")
    assert [parsed[i].error for i in range(len(TEXTS))] == [e for _, e in TEXTS]
    assert (parsed[0].year, parsed[0].num_votes, parsed[9].runtime) == (2008, 500, 90)
    refused = by_key(scoring.rejected(scoring.parse_requests(df)), "id")
    assert refused[1].status_code == 400 and refused[4].status_code == 500
    assert scoring.accepted(scoring.parse_requests(df)).count() == 3
    bodies = by_key(scoring.error_json(scoring.parse_requests(df)), "id")
    assert json.loads(bodies[1].response) == {"error": "genres field required"}
    assert parsed[16].director_hit_rate == 0.5


def test_response_repeats_the_request(spark):
    text = '{"genres":"Drama","year":2008.0, "b":6.0,"a":[1,"a"]}'
    df = spark.createDataFrame([(text,)], "request string")
    wanted = scoring.accepted(scoring.parse_requests(df))
    row = scoring.response_json(scoring.score_requests(wanted, predictor, BINS)).first()
    assert row.status_code == 200 and row.response.endswith(f',"input":{text}}}')
    assert json.loads(row.response) == {
        "predicted_rating": 8.0, "is_high_rated": True, "confidence_tier": "excellent",
        "input": json.loads(text)}


def test_a_stream_scores_like_a_batch(spark, samples, tmp_path):
    path = str(tmp_path / "requests")
    samples.repartition(3).write.json(path)
    stored = spark.read.schema(samples.schema).json(path)
    stream = spark.readStream.schema(samples.schema).option("maxFilesPerTrigger", 1).json(path)
    batch = scoring.score_requests(stored, predictor, BINS)
    streamed = updates.run_rows(scoring.score_requests(stream, predictor, BINS), "test")
    key = lambda r: str(r)
    assert sorted(streamed.collect(), key=key) == sorted(batch.collect(), key=key)


def test_scoring_moves_no_rows(spark, samples, tmp_path):
    path = str(tmp_path / "requests")
    samples.write.parquet(path)
    scored = scoring.score_requests(spark.read.parquet(path), predictor, BINS)
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()
