"""A training corpus in five stages, each one operator of ``marquee.llm``.

Each stage gets the session, what the stage before it kept, and the folder of the tables. All
but the last give back the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import decontaminate, quality, sentence_pieces, simhash, suffixes
from marquee.llm.common import load
from marquee.sources.tables import materialize


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that they reject go.

    Null, empty and blank texts go; rows that repeat each other stay or go together.
    """
    return quality.keep_good(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates: of each group the document with the least doc_id stays.

    Of rows repeated with that id and text one stays, and of a group with null ids only any one.
    Texts without words are one group.
    """
    return simhash.keep_one(docs, simhash.SHINGLE, simhash.DISTANCE)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 400 bytes found twice or more are cut out; every document stays.

    Null and shorter texts stay as they are. Texts that repeat each other, of 400 bytes or more,
    become empty, all of them: strings are judged on the input.
    """
    return suffixes.without_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have the question and answer of a benchmark item go.

    Null and empty texts stay, and without items everything does.
    """
    return decontaminate.keep_clean(docs, decontaminate.halves(load(spark, sf_dir, "benchmark")))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of whole texts, and the texts they decode to; other columns stay.

    A null or empty text has the begin and end ids and decodes to an empty one. Columns of
    ``docs`` named ``ids`` or ``n_tokens`` give way to the new ones.
    """
    made = ("doc_id", "text", "ids", "n_tokens", "n_chars")
    others = [f"row.`{c}`" for c in docs.columns if c not in made]
    return sentence_pieces.encode(docs, carry=True).select(
        "doc_id", *others, F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").alias("text"))


STAGES = [
    ("quality", good),
    ("simhash", distinct),
    ("suffixes", unrepeated),
    ("decontaminate", clean),
    ("sentencepiece", encoded),
]
# Fingerprints, byte windows and piece merges are beyond SQL; tests hold the rows against a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is stored and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
