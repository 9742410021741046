"""Finding text in titles through an index of their trigrams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.reports import title_search

SIZE = 3
# Lists met for a search: those of the text's rarest trigrams.
LISTS = 4
# A text whose rarest trigram is in a larger share of all titles is looked for in the titles themselves.
COMMON = 0.2


def trigrams(text: str) -> list[str]:
    return sorted({text[k:k + SIZE] for k in range(len(text) - SIZE + 1)})


def write_index(titles: DataFrame, path: str) -> None:
    """Store a row per trigram and title, in order, and how many titles each trigram has.

    Rows are dealt out by ranges of trigram and title, so a trigram that every title has fills many
    files, and a search reads the row groups of its own trigrams only.
    """
    spark, title = titles.sparkSession, F.col("primarytitle")
    places = F.sequence(F.lit(1), F.length(title) - SIZE + 1)
    grams = F.when(F.length(title) >= SIZE, F.transform(places, lambda k: F.substring(title, k, F.lit(SIZE))))
    rows = titles.select("tconst", F.explode(F.array_distinct(grams)).alias("gram")).distinct()
    rows.repartitionByRange("gram", "tconst").sortWithinPartitions("gram", "tconst").write.parquet(f"{path}/postings")
    stored = spark.read.parquet(f"{path}/postings")
    stored.groupBy("gram").agg(F.count("*").alias("titles")).repartitionByRange("gram").sortWithinPartitions(
        "gram").write.parquet(f"{path}/counts")
    titles.agg(F.count_distinct("tconst").alias("titles")).write.parquet(f"{path}/total")


def search(spark: SparkSession, path: str, titles: DataFrame, text: str) -> DataFrame:
    """What ``reports.title_search`` finds, the rows of ``titles`` being those of the index.

    Candidates are the titles in all lists looked at; they are then searched themselves. Text of
    less than a trigram, or of common ones only, is looked for in all titles.
    """
    grams = trigrams(text)
    if not grams:
        return title_search(titles, text)
    counts = spark.read.parquet(f"{path}/counts").filter(F.col("gram").isin(grams))
    known = {r.gram: r.titles for r in counts.collect()}
    if len(known) < len(grams):
        return title_search(titles.limit(0), text)
    rarest = sorted(grams, key=lambda g: (known[g], g))[:LISTS]
    if known[rarest[0]] > COMMON * spark.read.parquet(f"{path}/total").first().titles:
        return title_search(titles, text)
    lists = spark.read.parquet(f"{path}/postings").filter(F.col("gram").isin(rarest))
    held = lists.groupBy("tconst").agg(F.count("*").alias("n")).filter(F.col("n") == len(rarest)).select("tconst")
    return title_search(titles.join(held, "tconst", "left_semi"), text)
