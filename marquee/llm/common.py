"""Helpers the operators share: Arrow slices of bounded size, files beside tables, paths."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.session import ship_package

SLICE_BYTES = 2 << 20


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` whose ``column`` holds about ``limit`` bytes, or one longer row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for row, size in enumerate(sizes):
        if row > begin and held + size > limit:
            yield batch.slice(begin, row - begin)
            begin, held = row, 0
        held += int(size)
    if begin < batch.num_rows:
        yield batch.slice(begin)


def octets(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts as UTF-8; a null text is an empty one."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def map_text(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType | str,
             column: str = "text", limit: int = SLICE_BYTES) -> DataFrame:
    """Apply ``work`` to slices of bounded text size, partition by partition."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column, limit):
                yield work(part)

    return df.mapInArrow(run, schema)


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Columns named by their place, so that none can clash, and those names by the old ones.

    ``.toDF(*df.columns)`` gives the old names back.
    """
    names = {c: f"_{k}" for k, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def keep_rows(documents: DataFrame, judge: Callable[[list[bytes]], np.ndarray], column: str = "text") -> DataFrame:
    """The rows whose texts ``judge`` finds good, columns unchanged.

    Every row passes through Python once, with its text once, so nothing has to be joined back.
    """
    rows, names = numbered(documents)
    text = names[column]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(judge(octets(batch, text)), pa.bool_()))

    return map_text(rows, work, rows.schema, text).toDF(*documents.columns)


def narrow(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that others cannot clash with an operator's own."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values[bounds[i]:bounds[i + 1]]``; empty segments give 0."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``starts[0], starts[0] + 1, ...`` for each start and length, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


# --- files in the shared folder -------------------------------------------

def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path: plain paths are local, others go by their scheme."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def make_folder(uri: str) -> None:
    fs, path = filesystem(uri)
    fs.create_dir(path, recursive=True)


def attempt_name(label: str) -> str:
    """A file name of this task attempt's own.

    A repeated task writes another file. Only the manifest row of the attempt that Spark
    accepts names its file, so what a lost attempt left is never read.
    """
    from pyspark import TaskContext

    context = TaskContext.get()
    return f"{label}-{context.partitionId():06d}-{context.taskAttemptId()}"
