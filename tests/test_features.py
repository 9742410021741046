import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from rows import by_key, credits, ratings, titles

from marquee import vocabulary as V
from marquee.functions.bins import EqualWidthBins, integer_log_bin
from marquee.functions.keys import percent_of
from marquee.operators import cleaning, matrix, reputation, sampling


@pytest.fixture(scope="module")
def cleaned(spark):
    return cleaning.clean_titles(titles(spark), ratings(spark))


@pytest.fixture(scope="module")
def features(cleaned):
    return matrix.feature_matrix(cleaned)


def enriched(spark, cleaned):
    entries = reputation.director_entries(credits(spark))
    return reputation.with_directors(
        cleaned, reputation.primary_director(entries),
        reputation.director_stats(entries, ratings(spark)))


def test_feature_set_sizes():
    assert [len(s) for s in (V.BASE_FEATURES, V.INTERACTION_FEATURES, V.FULL_FEATURES)] == [
        28, 37, 43]


def test_base_features(features):
    assert len(features.columns) == 33
    rows = by_key(features)
    plain, empty, epic = rows["tt01"], rows["tt05"], rows["tt13"]
    assert plain.genre_drama == plain.genre_crime == 1 and plain.genre_sci_fi == 0
    assert rows["tt04"].genre_sci_fi == 1
    assert all(empty[g] == 0 for g in V.GENRE_FLAGS)
    assert plain.year_normalized == 99 / 124
    assert (rows["tt03"].is_classic, rows["tt03"].is_modern) == (1, 0)
    assert (rows["tt02"].decade_2000s, rows["tt04"].decade_2020s, epic.decade_2010s) == (1, 1, 1)
    assert empty.runtime_normalized == 95 / 180  # the typical runtime stands in
    assert (epic.is_epic, rows["tt04"].is_epic) == (1, 0)
    assert epic.votes_log == pytest.approx(math.log(50000))
    assert rows["tt04"].votes_normalized == 1.0
    assert (rows["tt03"].is_well_known, rows["tt04"].is_blockbuster) == (1, 1)


def test_feature_matrix_moves_no_rows(spark, cleaned, tmp_path):
    path = str(tmp_path / "cleaned")
    cleaned.write.parquet(path)
    plan = matrix.feature_matrix(spark.read.parquet(path))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_interactions(features):
    bins = EqualWidthBins.fit(features, "votes_log")
    rows = by_key(matrix.interaction_matrix(features, bins))
    epic = rows["tt13"]
    assert epic.long_drama == epic.is_drama_or_biography == epic.is_horror_thriller == 1
    assert rows["tt04"].is_action_adventure == 1
    assert rows["tt02"].modern_documentary == 1 and rows["tt02"].classic_documentary == 0
    # 49,999 votes: well known, more than a tenth of the scale, no blockbuster
    assert epic.popularity_score == 3.0 and rows["tt04"].popularity_score == 6.0
    assert rows["tt03"].popularity_score == 2.0  # 10,000 votes are not above a tenth
    assert epic.votes_log_squared == pytest.approx(math.log(50000) ** 2)


def test_existing_columns_are_left_alone(features):
    bins = EqualWidthBins(0.0, 1.0)
    kept = features.withColumn("popularity_score", F.lit(-1.0))
    row = matrix.with_interactions(kept, bins).first()
    assert row.popularity_score == -1.0


@pytest.mark.parametrize("values", [
    [1.0, 2.0, 3.0, 10.0, 5.5, 9.1, 1.9, 10.0, 1.0],
    list(np.random.default_rng(7).uniform(2.3, 14.9, 2000)),
    list(np.log(np.arange(10, 3000) + 1.0)),
    [4.2, 4.2, 4.2],
])
def test_bins_equal_pandas_cut(spark, values):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double")
    bins = EqualWidthBins.fit(df, "v")
    mine = [r.b for r in df.select("i", bins.index(F.col("v")).alias("b")).orderBy("i").collect()]
    assert mine == list(pd.cut(pd.Series(values), bins=10, labels=False).astype(float))


def test_bins_survive_json_and_clamp_new_values(spark):
    bins = EqualWidthBins.from_json(EqualWidthBins(0.1, 0.7 + 1e-16).to_json())
    assert bins == EqualWidthBins(0.1, 0.7 + 1e-16)
    df = spark.createDataFrame([(-5.0,), (99.0,), (None,)], "v double")
    assert [r[0] for r in df.select(bins.index(F.col("v"))).collect()] == [0.0, 9.0, None]


def test_bins_need_values(spark):
    with pytest.raises(ValueError):
        EqualWidthBins.fit(spark.createDataFrame([], "v double"), "v")


def test_integer_log_bin(spark):
    df = spark.createDataFrame([(2.99,), (9.5,), (12.0,)], "v double")
    assert [r[0] for r in df.select(integer_log_bin(F.col("v"))).collect()] == [2.0, 9.0, 9.0]


def test_one_pass_and_joined_matrix_agree(spark, cleaned, features):
    bins = EqualWidthBins.fit(features, "votes_log")
    directed = enriched(spark, cleaned)
    joined = matrix.training_matrix(features, directed, bins)
    single = matrix.training_matrix_in_one_pass(directed, bins)
    assert joined.columns == single.columns == V.ID_COLUMNS + V.FULL_FEATURES
    assert sorted(joined.collect()) == sorted(single.collect())


def test_merge_fills_titles_missing_from_the_director_table(spark, cleaned, features):
    some = enriched(spark, cleaned).filter("tconst = 'tt01'")
    rows = by_key(matrix.merge_directors(features, some.unionByName(some)))
    assert len(rows) == 6 and rows["tt03"].director_votes_log == 5.0


def test_log_threshold_admits_one_vote_less(features):
    assert sorted(by_key(matrix.reliable(features))) == ["tt04", "tt13"]


def test_missing_features_are_named(features):
    with pytest.raises(ValueError, match="votes_log_squared"):
        matrix.require_columns(features, V.INTERACTION_FEATURES)


def test_split_is_stable_and_near_the_share(spark):
    df = spark.range(20000).selectExpr("concat('tt', id) AS tconst")
    first = {r.tconst: r.split for r in matrix.with_split(df).collect()}
    again = {r.tconst: r.split for r in matrix.with_split(df.repartition(7)).collect()}
    assert first == again
    share = sum(s == "train" for s in first.values()) / len(first)
    assert 0.78 < share < 0.82


def test_percent_uses_the_whole_range(spark):
    seen = spark.range(5000).select(percent_of(F.col("id")).alias("p")).distinct().collect()
    assert {r.p for r in seen} == set(range(100))


def test_sample_is_repeatable_and_seeded(spark):
    df = spark.range(1000).selectExpr("concat('tt', id) AS tconst")
    pick = lambda d, seed: {r.tconst for r in sampling.sample_n(d, 50, seed=seed).collect()}
    assert pick(df, 42) == pick(df.repartition(5), 42) != pick(df, 99)
    assert sampling.sample_n(df, 2000).count() == 1000
