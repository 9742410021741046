"""The state of a job's alarm: raised once, cleared after a period without failures.

A window in which a job fails raises its alarm, if it is not raised already. A failing window that
begins ``quiet`` or more after the end of the last one, or the time passing that point, clears it.
Missing data is no failure. Times are in epoch seconds.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from marquee.session import ship_package
from marquee.streaming.job_metrics import FIVE_MINUTES

RAISED, CLEARED = "raised", "cleared"
TRANSITIONS = "job string, at long, state string"


def failing_windows(metrics: DataFrame, threshold: int = 1, period: str = FIVE_MINUTES) -> DataFrame:
    """``job``, ``begins`` and ``ends`` of windows in which a job failed at least ``threshold`` times."""
    window = F.window("ts", period)
    summed = metrics.groupBy(window, "job").agg(F.sum("failed").alias("failed")).filter(F.col("failed") >= threshold)
    begins, ends = (F.unix_timestamp(F.col(f"window.{side}")) for side in ("start", "end"))
    return summed.select("job", begins.alias("begins"), ends.alias("ends"))


def transitions(metrics: DataFrame, quiet: int, until: int | None = None, threshold: int = 1,
                period: str = FIVE_MINUTES) -> DataFrame:
    """All changes of all alarms, as known at ``until``, by default in the end.

    A job has a row per failing window in the window function, not per event.
    """
    failing = failing_windows(metrics, threshold, period)
    if until is not None:
        failing = failing.filter(F.col("ends") <= until)
    by_time = Window.partitionBy("job").orderBy("begins")
    before, after = F.lag("ends").over(by_time), F.lead("begins").over(by_time)
    quiet_from = F.col("ends") + quiet
    passed = F.lit(True) if until is None else quiet_from <= until
    raised = F.when(before.isNull() | (F.col("begins") >= before + quiet), F.col("begins"))
    cleared = F.when(F.when(after.isNull(), passed).otherwise(after >= quiet_from), quiet_from)
    both = F.array_compact(F.array(
        F.when(F.col("raised").isNotNull(), F.struct(F.col("raised").alias("at"), F.lit(RAISED).alias("state"))),
        F.when(F.col("cleared").isNotNull(), F.struct(F.col("cleared").alias("at"), F.lit(CLEARED).alias("state")))))
    changed = failing.select("job", raised.alias("raised"), cleared.alias("cleared"))
    return changed.select("job", F.inline(both))


def transitions_stream(metrics: DataFrame, quiet: int, threshold: int = 1, seconds: int = 300) -> DataFrame:
    """The same changes on a stream with a watermark, each as soon as the watermark allows.

    A job's state is when its alarm would be cleared, and the failures in windows of ``seconds`` that
    the watermark has not closed. A timer on the next of these times looks at the job again, so
    alarms of jobs that send nothing more are cleared, too, and the state ends. Spark has no column
    function for such a state, so a Python worker keeps it; failures are all that reaches it.
    """
    ship_package(metrics.sparkSession)

    def change(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs() // 1000
        until, begins, failed = state.get if state.exists else (None, [], [])
        held, rows = dict(zip(begins, failed)), []
        for batch in batches if not state.hasTimedOut else ():
            for window, n in batch.groupby(batch["second"] // seconds * seconds)["failed"].sum().items():
                held[window] = held.get(window, 0) + int(n)
        for window in sorted(w for w in held if w + seconds <= now):
            if held.pop(window) < threshold:
                continue
            if until is not None and window >= until:
                rows.append((until, CLEARED))
                until = None
            if until is None:
                rows.append((window, RAISED))
            until = window + seconds + quiet
        if until is not None and until <= now:
            rows.append((until, CLEARED))
            until = None
        later = [w + seconds for w in held] + [until] * (until is not None)
        if later:
            state.update((until, [int(w) for w in held], list(held.values())))
            state.setTimeoutTimestamp(int(min(later)) * 1000)
        elif state.exists:
            state.remove()
        if rows:
            yield pd.DataFrame({"job": key[0], "at": [int(at) for at, _ in rows], "state": [s for _, s in rows]})

    # a condition without the event time would go below the watermark, which then would only see failures
    failing = F.when(F.col("ts").isNotNull(), F.col("failed")) > 0
    failures = metrics.filter(failing).select("job", "failed", "ts", F.unix_timestamp("ts").alias("second"))
    return failures.groupBy("job").applyInPandasWithState(
        change, TRANSITIONS, "until long, begins array<long>, failed array<long>", "append",
        GroupStateTimeout.EventTimeTimeout)


def closed_until(metrics: DataFrame, delay: int, column: str = "ts") -> int:
    """Where the watermark of a stored table stands after all of it: its last time, less the delay."""
    last = metrics.agg(F.floor(F.unix_millis(F.max(column)) / 1000).alias("last")).first().last
    return (last or 0) - delay
