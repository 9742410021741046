"""The daily run: changed titles are merged into the cleaned table, untouched decades stay as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.sources.tables import materialize


def decades_of(df: DataFrame) -> set[int | None]:
    """At most a few dozen."""
    return {r.decade for r in df.select("decade").distinct().collect()}


def merge_cleaned(spark: SparkSession, path: str, changed: DataFrame, key: str = "tconst") -> set[int | None]:
    """Put ``changed`` into the cleaned table at ``path``; the decades that were written again.

    ``changed`` has a row per title, new or known; a known title that changes its decade leaves the old
    one. Of the table, only keys and decades are read in full, and rows of the decades touched. These
    are stored aside before they are written over, and a decade is replaced in one go, so a
    run that failed can be repeated. A decade that loses its last title loses its folder.
    """
    stored, changed = spark.read.parquet(path), materialize(changed, "changed")
    keys = changed.select(key)
    touched = decades_of(stored.select(key, "decade").join(keys, key, "left_semi")) | decades_of(changed)
    in_touched = F.col("decade").isin([d for d in touched if d is not None])
    if None in touched:
        in_touched |= F.col("decade").isNull()
    others = stored.filter(in_touched).join(keys, key, "left_anti")
    rows = materialize(others.unionByName(changed.select(others.columns)), "touched")
    (rows.hint("rebalance", "decade").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("decade").parquet(path))
    for decade in touched - decades_of(rows):
        folder = spark._jvm.org.apache.hadoop.fs.Path(
            f"{path}/decade={'__HIVE_DEFAULT_PARTITION__' if decade is None else decade}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return touched
