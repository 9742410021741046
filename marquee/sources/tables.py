"""Writing and reading tables, exports and small records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import vocabulary as V
from marquee.session import scratch_path


def write_cleaned(df: DataFrame, path: str) -> None:
    """Overwrite the cleaned table, one folder per decade.

    The rebalance hint brings a decade's rows together so that few files are written, and
    lets adaptive execution cut a decade that outgrows a task into several. Hashing on
    decade alone would give a popular decade to a single task.
    """
    (df.hint("rebalance", "decade")
       .write.mode("overwrite").partitionBy("decade").parquet(path))


def write_flat(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str, merge: bool = False) -> DataFrame:
    """Read a parquet folder, partitioned or flat; ``merge`` unites differing schemas."""
    return spark.read.option("mergeSchema", merge).parquet(path)


def write_split(df: DataFrame, path: str) -> None:
    """Write the train and test rows in one pass, one folder each."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def training_csv(df: DataFrame, features: Sequence[str] = V.FULL_FEATURES,
                 label: str = "target_rating") -> DataFrame:
    """The rows of a training export: label first, then features, nulls as 0."""
    return df.select(label, *features).na.fill(0)


def write_training_csv(df: DataFrame, path: str, features: Sequence[str] = V.FULL_FEATURES,
                       label: str = "target_rating") -> None:
    """Export for a trainer that expects the label first and no header line."""
    training_csv(df, features, label).write.mode("overwrite").option("header", False).csv(path)


# Text comes back as it was: spaces at its ends, line breaks, quotes, and empty beside missing.
_SAMPLE_CSV = {
    "header": True, "escape": '"', "nullValue": V.NULL_MARKER,
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def write_sample_csv(df: DataFrame, path: str) -> None:
    """Missing values are written as ``\\N``, which the raw files mark them with, too."""
    df.write.mode("overwrite").options(**_SAMPLE_CSV).csv(path)


def read_sample_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """A line break within quotes belongs to the value, so each file is read by one task."""
    return spark.read.schema(schema).options(**_SAMPLE_CSV, multiLine=True).csv(path)


def write_record(df: DataFrame, path: str) -> None:
    """Write the first row, such as a model's metrics, as one JSON line in one file."""
    df.limit(1).coalesce(1).write.mode("overwrite").json(path)


def write_split_csv(df: DataFrame, path: str, features: Sequence[str] = V.FULL_FEATURES,
                    label: str = "target_rating") -> None:
    """A training export for each value of ``split``, in a folder of its own, in one pass."""
    rows = df.select("split", label, *features).na.fill(0, [label, *features])
    rows.write.mode("overwrite").partitionBy("split").option("header", False).csv(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Store ``df`` in the shared folder and read it back.

    This cuts the lineage for jobs that pass over the same rows many times, and a lost
    executor costs a re-read instead of a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int | None = None) -> DataFrame:
    """Store ``df`` at ``path`` as table ``name`` in the catalog, dealt out and sorted by ``key``.

    Joins and groups by ``key`` then read it as it is: no exchange, and with as many buckets on both
    sides none at all. A table of that name is replaced. There are as many buckets as the session
    has shuffle partitions, unless said otherwise; each is one file, as rows are brought together
    first. A bucket goes to one task, so a key that very many rows share should be split before.
    """
    spark = df.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (df.repartition(count, key).write.mode("overwrite").option("path", path).bucketBy(count, key).sortBy(key)
     .saveAsTable(name))
    return spark.table(name)


def materialize_bucketed(df: DataFrame, label: str, key: str) -> DataFrame:
    """``materialize``, dealt out by ``key`` so that later joins by it leave these rows where they are."""
    path = scratch_path(df.sparkSession, label)
    return write_bucketed(df, f"marquee_{path.rsplit('-', 1)[1]}", path, key)


def only_missing(df: DataFrame, derived: dict) -> DataFrame:
    """Add the derived columns that ``df`` does not have yet."""
    return df.withColumns({n: c for n, c in derived.items() if n not in df.columns})


def missing_columns(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in wanted if c not in present]


def require_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Project to ``wanted``, or say which of them are missing."""
    missing = missing_columns(df, wanted)
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*wanted)


def available_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Project to those of ``wanted`` that exist."""
    present = set(df.columns)
    return df.select([F.col(c) for c in wanted if c in present])
