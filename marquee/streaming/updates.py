"""Running a stream to the end of its input and storing what it says.

Results go to a table in the shared folder, one folder per micro-batch, and the stream's
checkpoint lies within that table. So a table belongs to one run: continuing it continues the
checkpoint, and a batch that runs again after a failure overwrites its own folder.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from marquee.session import scratch_path

EPOCH = "epoch"
# below the table; readers skip names that begin so
CHECKPOINT = "_checkpoint"


class LateRowsDropped(RuntimeError):
    """Rows older than the watermark came in and are missing in the result."""


class _Progress(StreamingQueryListener):
    """Counts the rows that a query's watermark drops, over all its micro-batches."""

    def __init__(self):
        self.dropped: dict[str, int] = {}
        self.ended: dict[str, threading.Event] = {}

    def end_of(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        run = str(event.progress.runId)
        late = sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)
        self.dropped[run] = self.dropped.get(run, 0) + late

    def onQueryTerminated(self, event):
        self.end_of(str(event.runId)).set()


def run_to_table(stream: DataFrame, path: str, mode: str = "update", allow_late: bool = False,
                 each: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Process all input there is now, append each micro-batch to ``path``; the late rows.

    ``each`` changes a micro-batch before it is stored. A table that it reads is listed anew for
    every micro-batch, so rows that came late into it are seen by the batches after.

    In update mode a key may be written by several batches; ``latest`` keeps its last
    state. Unlike append mode this includes windows the watermark has not closed yet.

    Rows that the watermark drops are counted over all batches. They fail the run, as the sums
    lack them, unless ``allow_late`` says that this is wanted; the table has what came in time.
    When a stored table is replayed, the watermark must cover its disorder (``disorder``).
    """
    def store(batch: DataFrame, epoch: int) -> None:
        (each(batch) if each else batch).write.mode("overwrite").parquet(f"{path}/{EPOCH}={epoch}")

    spark, progress = stream.sparkSession, _Progress()
    spark.streams.addListener(progress)
    try:
        query = (stream.writeStream.outputMode(mode).foreachBatch(store)
                 .option("checkpointLocation", f"{path}/{CHECKPOINT}")
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        progress.end_of(str(query.runId)).wait(60)
        late = progress.dropped.get(str(query.runId), 0)
    finally:
        spark.streams.removeListener(progress)
    if late and not allow_late:
        raise LateRowsDropped(f"{late} rows came after the watermark and are not in {path}")
    return late


def disorder(events: DataFrame, column: str = "ts") -> str:
    """A watermark delay that covers any order of the rows of a stored table: its whole span."""
    seconds = F.unix_timestamp(F.max(column)) - F.unix_timestamp(F.min(column))
    return f"{(events.agg(seconds.alias('span')).first().span or 0) + 1} seconds"


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest state of each key in a table written by ``run_to_table``.

    All updates are regrouped. A long-lived stream is better stored in append mode, which
    writes each window once, when the watermark has closed it; its table is read as it is.
    """
    log = spark.read.parquet(path)
    values = [c for c in log.columns if c not in (*keys, EPOCH)]
    newest = F.max_by(F.struct(*values), EPOCH).alias("newest")
    return log.groupBy(*keys).agg(newest).select(*keys, "newest.*")


def run_updates(stream: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Run an aggregating stream in a fresh folder and return its final state."""
    path = scratch_path(stream.sparkSession, label)
    run_to_table(stream, path)
    return latest(stream.sparkSession, path, keys)


def run_rows(stream: DataFrame, label: str, each: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Run a stream in append mode and return all it wrote.

    Without aggregation these are all rows, with windows those that the watermark has closed.
    """
    path = scratch_path(stream.sparkSession, label)
    run_to_table(stream, path, mode="append", each=each)
    return stream.sparkSession.read.parquet(path).drop(EPOCH)
