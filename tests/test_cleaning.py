import pandas as pd
import pytest
from pyspark.sql import functions as F
from rows import by_key, ratings, titles

from marquee import vocabulary as V
from marquee.functions.bands import band
from marquee.operators import cleaning


@pytest.fixture(scope="module")
def cleaned(spark):
    return by_key(cleaning.clean_titles(titles(spark), ratings(spark)))


def test_only_sound_rated_movies_are_kept(cleaned):
    assert sorted(cleaned) == ["tt01", "tt02", "tt03", "tt04", "tt05", "tt13"]


def test_columns_and_types(spark):
    df = cleaning.clean_titles(titles(spark), ratings(spark))
    assert df.columns == V.CLEANED_COLUMNS
    kinds = dict(df.dtypes)
    assert kinds["startyear"] == kinds["decade"] == kinds["numvotes"] == "int"
    assert kinds["averagerating"] == "float"


@pytest.mark.parametrize("key, rating, runtime, votes, decade", [
    ("tt01", "poor", "short", "obscure", 1990),
    ("tt02", "average", "standard", "known", 2000),
    ("tt03", "good", "standard", "popular", 1960),
    ("tt04", "excellent", "long", "blockbuster", 2020),
    ("tt05", "average", "unknown", "obscure", 1900),
])
def test_bands_at_their_edges(cleaned, key, rating, runtime, votes, decade):
    row = cleaned[key]
    assert (row.rating_tier, row.runtime_bucket, row.vote_tier, row.decade) == (
        rating, runtime, votes, decade)
    assert row.is_high_rated == (1 if rating in ("good", "excellent") else 0)


def test_text_that_is_no_number_becomes_null(spark):
    typed = by_key(cleaning.typed_titles(titles(spark)))
    assert typed["tt06"].startyear is None
    assert typed["tt01"].startyear == 1999


def test_right_closed_bands_equal_pandas_cut(spark):
    values = [-1.0, 0.0, 0.5, 5.0, 5.1, 7.0, 7.5, 8.0, 9.0, 10.0, 10.5, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    mine = df.select(band("v", V.RATING_CUTS, V.RATING_TIERS, "right", low=0, high=10).alias("b"))
    cut = pd.cut(pd.Series(values, dtype=float), [0, 5, 7, 8, 10], labels=V.RATING_TIERS)
    assert [r.b for r in mine.collect()] == [None if pd.isna(x) else x for x in cut]


def test_band_rejects_wrong_label_count():
    with pytest.raises(ValueError):
        band("v", [1, 2], ["a", "b"])


def test_the_check_is_never_unknown(spark):
    joined = cleaning.rated_movies(titles(spark), ratings(spark))
    assert joined.filter(cleaning.is_clean().isNull()).count() == 0


def test_filters_reach_the_parquet_scan(spark, conf, tmp_path):
    conf("spark.sql.maxMetadataStringLength", "10000")
    path = str(tmp_path / "ratings")
    cleaning.typed_ratings(ratings(spark)).write.parquet(path)
    stored = cleaning.clean_titles(titles(spark), spark.read.parquet(path))
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(numvotes,10)" in plan
    assert "GreaterThanOrEqual(averagerating,1.0)" in plan


def test_duplicated_ratings_keep_every_pair(spark):
    doubled = ratings(spark).unionByName(ratings(spark))
    assert cleaning.clean_titles(titles(spark), doubled).count() == 12
    assert cleaning.clean_titles(titles(spark), doubled).agg(
        F.count_distinct("tconst")).first()[0] == 6
