"""Lines that cannot be read as they should: kept with file, text and reason, and counted.

``read_tsv`` makes null of what cannot be read. Here such lines are set aside instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import vocabulary as V

# The columns of the raw files that hold numbers, and of which kind.
TITLE_NUMBERS = {"startYear": "int", "runtimeMinutes": "int", "isAdult": "int"}
RATING_NUMBERS = {"averageRating": "float", "numVotes": "int"}
CREDIT_NUMBERS = {"ordering": "int"}


class TooManyRefused(RuntimeError):
    """More lines were set aside than a run may lose."""


class QualityTooLow(RuntimeError):
    """A measure fell below its limit."""


def checked_lines(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str],
                  numbers: dict[str, str]) -> DataFrame:
    """Every line but headers, with its ``file``, its ``fields`` and what is wrong with it, in ``reasons``."""
    read = spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path))
    line = F.regexp_replace("value", "\r$", "")
    lines = read.select(F.col("_metadata.file_path").alias("file"), line.alias("line")).filter(
        F.col("line") != "\t".join(columns))
    fields = F.transform(F.split("line", "\t"), lambda f: F.when(f != V.NULL_MARKER, f))
    found = F.size("fields")
    wrong = [F.when(found != len(columns), F.concat(found.cast("string"), F.lit(f" fields, not {len(columns)}")))]
    for name, kind in numbers.items():
        value = F.get("fields", F.lit(list(columns).index(name)))
        wrong.append(F.when((found == len(columns)) & value.isNotNull() & value.try_cast(kind).isNull(),
                            f"{name.lower()} is no {kind}"))
    return lines.withColumn("fields", fields).withColumn("reasons", F.array_compact(F.array(*wrong)))


def sound(checked: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The lines with nothing wrong, as ``read_tsv`` gives them."""
    return checked.filter(F.size("reasons") == 0).select(
        *[F.get("fields", F.lit(k)).alias(c.lower()) for k, c in enumerate(columns)])


def refused(checked: DataFrame) -> DataFrame:
    """The others: where they are from, as they were, and all reasons."""
    return checked.filter(F.size("reasons") > 0).select("file", "line", "reasons")


def reason_counts(checked: DataFrame) -> DataFrame:
    """Lines by reason, sound ones included; a line with several reasons counts for each."""
    reason = F.when(F.size("reasons") == 0, F.array(F.lit("sound"))).otherwise(F.col("reasons"))
    return checked.select(F.explode(reason).alias("reason")).groupBy("reason").agg(F.count("*").alias("lines"))


def take_in(checked: DataFrame, columns: Sequence[str], refused_path: str, most_refused: float = 0.01) -> DataFrame:
    """The sound lines, the others stored; a run that would lose more than a share of them is stopped."""
    refused(checked).write.mode("overwrite").parquet(refused_path)
    lines, lost = checked.agg(F.count("*"), F.count_if(F.size("reasons") > 0)).first()
    if lost > most_refused * lines:
        raise TooManyRefused(f"{lost} of {lines} lines were refused, see {refused_path}")
    return sound(checked, columns)


def require(measures: DataFrame, limits: dict[str, float]) -> dict[str, float]:
    """Stop a run whose measures, one row of them, fall below their limits or are missing."""
    found = measures.select(*limits).first().asDict()
    low = {name: found[name] for name, limit in limits.items() if found[name] is None or found[name] < limit}
    if low:
        raise QualityTooLow(", ".join(f"{name} is {value}, not {limits[name]}" for name, value in low.items()))
    return found
