"""Catalog tables and views, so that plain SQL can be run over the cleaned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee import vocabulary as V
from marquee.operators import reports

VIEWS = {
    "v_decade_stats": reports.decade_stats,
    "v_genre_stats": reports.genre_stats,
    "v_movies_summary": reports.movies_summary,
    "v_top_movies": reports.reliable_movies,
}

# The same views as text, which is what a catalog keeps. {table} is the stored cleaned table.
GROUP_MEASURES = """count(*) AS movie_count, round(avg(averagerating), 2) AS avg_rating,
  {more}sum(numvotes) AS total_votes, sum(is_high_rated) AS high_rated_count"""
VIEW_SQL = {
    "v_decade_stats": "SELECT decade, "
    + GROUP_MEASURES.format(more="max(averagerating) AS max_rating, ")
    + " FROM {table} GROUP BY decade",
    "v_genre_stats": "SELECT genres, " + GROUP_MEASURES.format(more="")
    + f" FROM {{table}} WHERE numvotes >= {V.VOTE_CUTS[0]} GROUP BY genres HAVING count(*) >= 50",
    "v_movies_summary": f"SELECT {', '.join(V.SUMMARY_COLUMNS)} FROM {{table}}",
    "v_top_movies": "SELECT primarytitle, startyear, genres, averagerating, numvotes, rating_tier, "
    f"runtime_bucket FROM {{table}} WHERE numvotes >= {V.RELIABLE_VOTES}",
}


def register_views(cleaned: DataFrame, table: str = "cleaned") -> None:
    """Register ``cleaned`` and its four views for this session only, as temporary views."""
    cleaned.createOrReplaceTempView(table)
    base = cleaned.sparkSession.table(table)
    for name, define in VIEWS.items():
        define(base).createOrReplaceTempView(name)


def register_stored(spark: SparkSession, path: str, table: str = "cleaned",
                    prefix: str = "") -> None:
    """Register a stored cleaned table and its four views in the catalog.

    They outlive the session where the catalog does. The table stays where it is stored,
    partitioned by decade, so a view asked for some decades reads their folders only. An
    entry of the same name is replaced; its files are not touched. ``prefix`` goes before the
    views' names.
    """
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.catalog.createTable(table, path=path, source="parquet")
    spark.catalog.recoverPartitions(table)
    for name, text in VIEW_SQL.items():
        spark.sql(f"CREATE OR REPLACE VIEW {prefix}{name} AS {text.format(table=table)}")
