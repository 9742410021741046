import math

import pytest
from pyspark.sql import functions as F
from rows import by_key, credits, ratings, titles

from marquee import vocabulary as V
from marquee.operators import cleaning, reputation
from marquee.operators.joins import balanced_left_join


def build(spark):
    entries = reputation.director_entries(credits(spark))
    stats = reputation.director_stats(entries, ratings(spark))
    cleaned = cleaning.clean_titles(titles(spark), ratings(spark))
    primary = reputation.primary_director(entries)
    return entries, stats, primary, reputation.with_directors(cleaned, primary, stats)


def test_stats_cover_all_rated_titles_of_any_type(spark):
    stats = by_key(build(spark)[1], "director_id")
    assert set(stats) == {"nm1", "nm2", "nm3"}  # nm7 has no rated title, nm9 is an actor
    first, second = stats["nm1"], stats["nm2"]
    assert first.director_movie_count == 3 and first.has_known_director == 1
    assert first.director_avg_rating == pytest.approx(5.633)
    assert first.director_avg_votes == 4000.0
    assert first.director_votes_log == pytest.approx(math.log(4001))
    assert first.director_hit_rate == 0.333
    assert second.director_movie_count == 2 and second.has_known_director == 0
    assert second.director_max_rating == 9.0  # the episode counts


def test_first_billed_director_wins_and_ties_go_to_the_lower_id(spark):
    primary = {k: r.director_id for k, r in by_key(build(spark)[2]).items()}
    assert primary == {"tt01": "nm2", "tt02": "nm1", "tt03": "nm1", "tt09": "nm2", "tt10": "nm7"}


def test_repeated_credits_give_one_director_per_title(spark):
    doubled = credits(spark).unionByName(credits(spark))
    primary = reputation.primary_director(reputation.director_entries(doubled))
    assert primary.count() == primary.select("tconst").distinct().count() == 5


def test_unknown_directors_get_fixed_values(spark):
    enriched = by_key(build(spark)[3])
    assert len(enriched) == 6
    row = enriched["tt04"]
    assert row.director_id is None and row.director_avg_votes is None
    assert {c: row[c] for c in V.UNKNOWN_DIRECTOR} == pytest.approx(V.UNKNOWN_DIRECTOR)


def test_every_director_of_a_cleaned_title_has_stats(spark):
    enriched = build(spark)[3]
    odd = enriched.filter(F.col("director_id").isNotNull() & F.col("director_avg_votes").isNull())
    assert odd.count() == 0


def test_a_title_key_that_looks_like_a_director_does_not_match(spark):
    cleaned = cleaning.clean_titles(titles(spark), ratings(spark)).withColumn(
        "tconst", F.when(F.col("tconst") == "tt05", "nm1").otherwise(F.col("tconst")))
    _, stats, primary, _ = build(spark)
    row = by_key(reputation.with_directors(cleaned, primary, stats))["nm1"]
    assert row.director_id is None and row.director_movie_count == 1


@pytest.fixture()
def no_broadcast(conf):
    """Make partitions of a few kilobytes count as skewed, and rule out broadcasts."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "10KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "8")


def wide_titles(spark, n):
    return spark.range(n).selectExpr(
        "concat('tt', id) AS tconst", "'movie' AS titletype",
        "sha2(cast(id AS string), 512) AS primarytitle", "'' AS originaltitle",
        "2000 AS startyear", "100 AS runtimeminutes", "'Drama' AS genres", "0 AS isadult")


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_director_of_a_third_of_all_titles_is_split(spark, no_broadcast):
    n = 6000
    rated = spark.range(n).selectExpr(
        "concat('tt', id) AS tconst", "6.0F AS averagerating", "100 AS numvotes")
    entries = spark.range(n).selectExpr(
        "concat('tt', id) AS tconst", "1 AS ordering",
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('nm', id) END AS director_id",
    ).repartition(8)
    cleaned = cleaning.clean_titles(wide_titles(spark, n), rated)
    enriched = reputation.with_directors(
        cleaned, reputation.primary_director(entries), reputation.director_stats(entries, rated))
    assert "skew=true" in final_plan(enriched)
    hot = enriched.filter("director_id = 'hot'")
    assert enriched.count() == n
    assert hot.count() == hot.first().director_movie_count == n // 3


def test_wide_rows_are_shuffled_once(spark, no_broadcast):
    """Cleaning deals the titles out; the directors come to them, not the other way round."""
    n = 2000
    rated = spark.range(n).selectExpr(
        "concat('tt', id) AS tconst", "6.0F AS averagerating", "100 AS numvotes")
    entries = spark.range(n).selectExpr(
        "concat('tt', id) AS tconst", "1 AS ordering", "concat('nm', id % 50) AS director_id")
    cleaned = cleaning.clean_titles(wide_titles(spark, n), rated)
    enriched = reputation.with_directors(
        cleaned, reputation.primary_director(entries), reputation.director_stats(entries, rated))
    plan = enriched._jdf.queryExecution().sparkPlan().toString()
    physical = enriched._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and physical.count("Exchange hashpartitioning") <= 9


def test_a_title_with_a_third_of_all_credits_is_split(spark, no_broadcast):
    n = 30000
    entries = spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('tt', id) END AS tconst",
        "cast(id AS int) AS ordering", "concat('nm', id % 700) AS director_id",
    ).repartition(8)
    rated = spark.range(n).selectExpr(
        "CASE WHEN id = 0 THEN 'hot' ELSE concat('tt', id) END AS tconst",
        "6.0F AS averagerating", "100 AS numvotes")
    stats = reputation.director_stats(entries, rated)
    assert "skew=true" in final_plan(stats)
    assert stats.agg(F.sum("director_movie_count")).first()[0] == n


def test_a_title_with_a_third_of_all_rows_is_split_in_both_joins(spark, no_broadcast):
    n = 6000
    key = "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('tt', id) END"
    copies = wide_titles(spark, n).withColumn("id", F.monotonically_increasing_id())
    copies = copies.withColumn("tconst", F.expr(key)).drop("id").repartition(8)
    rated = spark.range(n).selectExpr(
        "CASE WHEN id = 0 THEN 'hot' ELSE concat('tt', id) END AS tconst",
        "6.0F AS averagerating", "100 AS numvotes")
    cleaned = cleaning.clean_titles(copies, rated)
    kept = cleaned.count()
    assert "skew=true" in final_plan(cleaned) and kept >= n // 3
    primary = spark.range(n).selectExpr(
        "CASE WHEN id = 0 THEN 'hot' ELSE concat('tt', id) END AS tconst",
        "1 AS ordering", "concat('nm', id % 50) AS director_id")
    primary = reputation.primary_director(primary)
    joined = balanced_left_join(copies, primary, "tconst")
    assert "skew=true" in final_plan(joined) and joined.count() == n


def test_titles_without_director_spread_over_partitions(spark, no_broadcast):
    n = 4000
    rated = spark.range(n).selectExpr(
        "concat('tt', id) AS tconst", "6.0F AS averagerating", "100 AS numvotes")
    entries = spark.createDataFrame(
        [("tt1", 1, "nm1")], "tconst string, ordering int, director_id string")
    cleaned = cleaning.clean_titles(wide_titles(spark, n), rated)
    enriched = reputation.with_directors(
        cleaned, reputation.primary_director(entries), reputation.director_stats(entries, rated))
    plan = final_plan(enriched)
    assert "skew=true" not in plan  # nothing left to split
    sizes = [r["count"] for r in enriched.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == n and max(sizes) < n / 2
