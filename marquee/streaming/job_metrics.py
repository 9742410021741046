"""Windowed metrics of jobs and their alarms, in batch or on a stream.

Input rows carry ``ts``, ``job``, the counts ``completed`` and ``failed`` and the measure
``elapsed``. Groups combine map-side before the shuffle, so a job that sends a third of
all rows is no burden.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIVE_MINUTES = "300 seconds"
ONE_DAY = "1 day"


def windowed(metrics: DataFrame, period: str, *measures: Column,
             keys: tuple[str, ...] = ("job",)) -> DataFrame:
    """Aggregate per tumbling window and key; ``window_start`` is in epoch seconds.

    A window without rows gives no row, so missing data raises no alarm.
    """
    window = F.window("ts", period)
    grouped = metrics.groupBy(window, *keys).agg(*measures)
    start = F.unix_timestamp(F.col("window.start")).alias("window_start")
    rest = [c for c in grouped.columns if c != "window"]
    return grouped.select(start, *rest)


def task_sums(metrics: DataFrame, period: str = FIVE_MINUTES) -> DataFrame:
    return windowed(metrics, period, F.sum("completed").alias("completed"),
                    F.sum("failed").alias("failed"))


def elapsed_average(metrics: DataFrame, period: str = FIVE_MINUTES) -> DataFrame:
    return windowed(metrics, period, F.avg("elapsed").alias("avg_elapsed"))


def daily_average(metrics: DataFrame, measure: str = "elapsed") -> DataFrame:
    return windowed(metrics, ONE_DAY, F.avg(measure).alias(f"avg_{measure}"), keys=())


def alarms(sums: DataFrame, threshold: int = 1) -> DataFrame:
    """Windows in which a job failed at least ``threshold`` times."""
    return sums.filter(F.col("failed") >= threshold)


def counted_once(metrics: DataFrame, *keys: str) -> DataFrame:
    """Each event once, though its file or message came again.

    On a stream an event's key is kept until the watermark is its delay past its time, so the state ends; a
    repeat that comes later than the watermark's delay counts as new.
    """
    if metrics.isStreaming:
        return metrics.dropDuplicatesWithinWatermark(list(keys))
    return metrics.dropDuplicates(list(keys))
