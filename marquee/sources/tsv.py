"""Reading the raw tab-separated title files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import vocabulary as V

# The header lines of the raw files.
TITLE_COLUMNS = [
    "tconst", "titleType", "primaryTitle", "originalTitle", "isAdult",
    "startYear", "endYear", "runtimeMinutes", "genres",
]
RATING_COLUMNS = ["tconst", "averageRating", "numVotes"]
CREDIT_COLUMNS = ["tconst", "ordering", "nconst", "category", "job", "characters"]


def lowercase_names(df: DataFrame) -> DataFrame:
    """Give every column its lowercase name, once, at the door."""
    return df.select([F.col(f"`{c}`").alias(c.lower()) for c in df.columns])


def read_tsv(spark: SparkSession, path: str | Sequence[str],
             columns: Sequence[str] | None = None,
             partitions: int | None = None) -> DataFrame:
    """Read headered TSV files, all columns as strings, ``\\N`` as null.

    Quotes are ordinary characters here: a title may open one and never close it.
    ``columns`` states the header expected; a file with another header fails instead of
    being read into the wrong columns. Without it, names come from the file.

    A gzip file is one task until it is unpacked, so ``path`` should be many part files
    at scale. Rows stay where they are read unless ``partitions`` says over how many tasks to
    spread them, which pays for a few large gzip files.
    """
    reader = (
        spark.read.option("sep", "\t").option("header", True)
        .option("nullValue", V.NULL_MARKER).option("quote", "")
    )
    if columns is not None:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        reader = reader.schema(schema).option("enforceSchema", False)
    df = lowercase_names(reader.csv(path if isinstance(path, str) else list(path)))
    return df if partitions is None else df.repartition(partitions)
