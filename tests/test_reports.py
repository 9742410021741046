import pytest
from pyspark.sql import functions as F
from rows import credits, ratings, titles

from marquee.operators import cleaning, matrix, quality, reports, reputation
from marquee.sources import catalog


@pytest.fixture(scope="module")
def cleaned(spark):
    df = cleaning.clean_titles(titles(spark), ratings(spark)).cache()
    yield df
    df.unpersist()


def popular(spark, n, rating="7.0F"):
    return spark.range(n).selectExpr(
        "concat('tt', lpad(id, 4, '0')) AS tconst", "concat('T', id) AS primarytitle",
        "2000 AS startyear", f"{rating} AS averagerating", "60000 AS numvotes",
        "'Drama' AS genres", "'standard' AS runtime_bucket", "1 AS is_high_rated")


def test_tier_counts_and_shares_add_up(cleaned):
    rows = reports.tier_share(cleaned).collect()
    assert sum(r["count"] for r in rows) == cleaned.count() == 6
    assert [r["count"] for r in rows] == sorted((r["count"] for r in rows), reverse=True)
    assert sum(r.percentage for r in rows) == pytest.approx(100, abs=0.2)


def test_decades_are_ordered(cleaned):
    rows = reports.movies_per_decade(cleaned).collect()
    assert [r.decade for r in rows] == [1900, 1960, 1990, 2000, 2010, 2020]
    assert rows[3].avg_rating == 5.0 and rows[3].max_votes == 1000


def test_equal_ratings_have_a_fixed_order(spark):
    df = popular(spark, 60)
    first = [r.primarytitle for r in reports.top_movies(df).collect()]
    again = [r.primarytitle for r in reports.top_movies(df.repartition(7)).collect()]
    assert first == again == [f"T{i}" for i in range(20)]


def test_top_list_sorts_no_more_than_it_needs(spark):
    plan = reports.top_movies(popular(spark, 60))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_exact_vote_threshold_differs_from_the_log_one(cleaned):
    assert reports.top_movies(cleaned).count() == 1  # 49,999 votes are too few here


def test_genres_need_enough_titles(spark):
    few, many = popular(spark, 49), popular(spark, 50)
    assert reports.best_genres(few).count() == 0 and reports.best_genres(many).count() == 1
    assert reports.panel_genres(few).count() == 1


def test_reports_combine_before_the_shuffle(cleaned):
    plan = reports.best_genres(cleaned)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_avg" in plan


def test_views_answer_sql(spark, cleaned):
    catalog.register_views(cleaned)
    assert spark.sql("SELECT sum(movie_count) FROM v_decade_stats").first()[0] == 6
    assert spark.sql("SELECT count(*) FROM v_movies_summary WHERE decade = 1960").first()[0] == 1
    assert len(spark.table("v_movies_summary").columns) == 11
    assert spark.table("v_top_movies").count() == 1
    assert spark.table("v_genre_stats").count() == 0


def test_health_and_completeness(cleaned):
    health = quality.dq_health(cleaned).first()
    assert health.total_records == health.decades_covered == 6
    assert health.data_completeness_pct == 100.0
    by_decade = {r.decade: r for r in quality.dq_by_decade(cleaned).collect()}
    assert by_decade[1900].runtime_completeness == 0.0 and by_decade[1900].has_runtime == 0
    assert by_decade[1990].runtime_completeness == 100.0


def test_an_empty_table_has_no_completeness(cleaned):
    none = cleaned.filter("false")
    assert quality.dq_completeness(none).first().title_completeness is None
    assert quality.dq_health(none).first().total_records == 0
    assert quality.dq_by_decade(none).count() == reports.tier_share(none).count() == 0


def test_search_treats_missing_names_as_no_match(spark):
    found = reports.title_search(titles(spark), "Edge").collect()
    assert {r.tconst for r in found} == {"tt02", "tt03", "tt04"}


def test_stage_counts(spark):
    counts = quality.stage_counts(titles(spark), ratings(spark), credits(spark)).collect()
    assert dict(counts) == {
        "titles": 13, "movies": 12, "ratings": 12, "joined": 11, "clean": 6,
        "director_entries": 7, "directors": 3, "enriched": 6, "features": 6,
    }
    later = quality.stage_counts(titles(spark), ratings(spark), credits(spark), features=titles(spark))
    assert dict(later.collect())["features"] == 13


def test_stage_counts_join_once_per_pair(spark):
    plan = quality.stage_counts(titles(spark), ratings(spark), credits(spark))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join ") == 2


def test_value_counts_leave_out_nulls(cleaned):
    assert {r.genres for r in quality.value_counts(cleaned, "genres").collect()} == {
        "Drama,Crime", "Documentary", "Biography", "Action,Adventure,Sci-Fi", "Drama,Horror"}


def test_describe(cleaned):
    row = quality.describe(cleaned, "numvotes").first()
    assert (row.n, row.min, row.max) == (6, 10, 100000)
    assert row["std"] == pytest.approx(cleaned.agg(F.stddev("numvotes")).first()[0])


def test_flag_totals(cleaned):
    rows = quality.flag_totals(matrix.feature_matrix(cleaned)).collect()
    assert len(rows) == 8 and (rows[0].flag, rows[0].total) == ("genre_drama", 2)


def test_flag_counts(spark, cleaned):
    entries = reputation.director_entries(credits(spark))
    enriched = reputation.with_directors(
        cleaned, reputation.primary_director(entries),
        reputation.director_stats(entries, ratings(spark)))
    row = quality.flag_counts(enriched).first()
    assert (row.null_runtimes, row.modern, row.classic, row.epics) == (1, 3, 2, 1)
    assert (row.well_known, row.blockbusters, row.known_directors) == (3, 1, 2)
