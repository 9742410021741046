"""Documents packed into sequences of tokens, online, by the sum of squares of open windows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import load, narrow, ship_package, slices
from marquee.llm.pieces import encoder
from marquee.sources.tables import materialize

WINDOW = 2048
END_ID = 1
# Open windows that a task keeps: 16 MB of ids in 2 bytes each.
OPEN = 4096
# A task numbers its sequences from its own multiple of this.
NUMBERS = 1 << 40


@dataclass
class Piece:
    """Ids of a document from ``start`` on, out of ``total``."""

    doc_id: int | None
    start: int
    total: int
    ids: np.ndarray

    def cut(self, count: int) -> tuple[Piece, Piece]:
        rest = Piece(self.doc_id, self.start + count, self.total, self.ids[count:])
        return Piece(self.doc_id, self.start, self.total, self.ids[:count]), rest


@dataclass
class Packer:
    """Open windows by fill level, and how many there are at each.

    A piece goes to the level for which the sum over all levels of the squared number of open
    windows comes out least; empty and full windows do not count. Ties go to the fullest window.

    Lengths that never add up to a window, such as all alike and over half of one, would leave ever
    more windows open. Beyond ``most`` open windows, they are filled up by cutting pieces.
    """

    size: int = WINDOW
    most: int = OPEN
    levels: np.ndarray = field(init=False)
    windows: dict[int, list[list[Piece]]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.levels = np.zeros(self.size + 1, np.int64)

    def level(self, length: int) -> int:
        """The fill level that a piece of ``length`` ids goes to; 0 opens a window.

        Moving a window from level h to h + length changes the sum of squares by
        2 (n[h + length] - n[h] + 1), with no such term for an empty or a full window.
        """
        highest = self.size - length
        before, after = self.levels[:highest + 1], self.levels[length:self.size + 1]
        change = 2 * (after - before + 1)
        change[0] = 2 * after[0] + 1
        change[highest] = 1 - 2 * before[highest]
        allowed = before > 0
        allowed[0] = True
        found = np.flatnonzero(allowed)
        return int(found[::-1][change[found][::-1].argmin()])

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Place a document; windows that this fills are given back."""
        while len(piece.ids) >= self.size:
            full, piece = piece.cut(self.size)
            yield [full]
        length = len(piece.ids)
        if not length:
            return
        level = self.level(length)
        window = self._take(level) if level else []
        window.append(replace(piece, ids=piece.ids.copy()))  # not a view that keeps a long text alive
        if level + length == self.size:
            yield window
        else:
            self._put(level + length, window)
            if self.levels.sum() > self.most:
                yield from self.settle()

    def _take(self, level: int) -> list[Piece]:
        self.levels[level] -= 1
        return self.windows[level].pop()

    def _put(self, level: int, window: list[Piece]) -> None:
        self.levels[level] += 1
        self.windows.setdefault(level, []).append(window)

    def settle(self) -> Iterator[list[Piece]]:
        """Leave one window open at most.

        The fullest open windows are filled up with pieces of the emptiest, cut where a window ends.
        """
        left = [w for level in sorted(self.windows, reverse=True) for w in self.windows[level]]
        spare: list[Piece] = []
        self.levels[:], self.windows = 0, {}
        low, high = 0, len(left)
        while low < high:
            window = left[low]
            low += 1
            room = self.size - sum(len(p.ids) for p in window)
            while room and (spare or low < high):
                if not spare:
                    high -= 1
                    spare = left[high]
                room -= self._move(spare, window, room)
            if room:
                spare = window
            else:
                yield window
        if spare:
            self._put(sum(len(p.ids) for p in spare), spare)

    def close(self) -> Iterator[list[Piece]]:
        """Empty the packer: no sequence it gives needs padding.

        What is left open at last, less than one window, is cut into powers of two.
        """
        yield from self.settle()
        spare = [p for windows in self.windows.values() for w in windows for p in w]
        self.levels[:], self.windows = 0, {}
        held = sum(len(p.ids) for p in spare)
        while held:
            power = 1 << (held.bit_length() - 1)
            window, room = [], power
            while room:
                room -= self._move(spare, window, room)
            held -= power
            yield window

    @staticmethod
    def _move(source: list[Piece], target: list[Piece], room: int) -> int:
        """Move the last piece of ``source``, or its first ``room`` ids."""
        piece = source.pop()
        if len(piece.ids) > room:
            piece, rest = piece.cut(room)
            source.append(rest)
        target.append(piece)
        return len(piece.ids)


PACKED = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, ids array<int>")


def pack(documents: DataFrame, size: int = WINDOW, tokenizer: str | None = None, end: int = END_ID,
         carry_ids: bool = True) -> DataFrame:
    """Pieces of documents in sequences of at most ``size`` tokens, one row per piece.

    Every task packs the documents it reads, each text encoded whole with ``end`` behind it, and
    numbers its sequences by itself, so nothing is shuffled and a copied text costs no more than
    any other. A document of a window or more first fills windows of its own. Open windows are
    kept per task: a few MB of ids. Sequences hold ``size`` tokens, but for the last few of a task,
    whose lengths are powers of two. Without ``carry_ids`` the ids themselves are left out.

    Null and empty texts give the end id only. Rows with equal or null doc_ids are packed as
    documents of their own. An empty table gives an empty one. Other columns are not read. Store
    the result before reading it twice, if ``documents`` does not come in a fixed order.
    """
    if size & (size - 1) or size < 1:
        raise ValueError("the size of a sequence must be a power of two")
    ship_package(documents.sparkSession)

    def rows(windows: Iterator[list[Piece]], first: int) -> Iterator[pa.RecordBatch]:
        number, held = first, []

        def batch() -> pa.RecordBatch:
            pieces = [p for _, w in held for p in w]
            counts = np.array([len(p.ids) for p in pieces], np.int64)
            offsets = np.concatenate([np.cumsum([0, *(len(p.ids) for p in w[:-1])]) for _, w in held])
            packed = [p.ids.astype("<u4") for p in pieces]
            columns = {
                "doc_id": pa.array([p.doc_id for p in pieces], pa.int64()),
                "start": pa.array([p.start for p in pieces], pa.int64()),
                "length": pa.array(counts),
                "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in packed], pa.int64()),
                "doc_tokens": pa.array([p.total for p in pieces], pa.int64()),
                "sequence_id": pa.array(np.repeat([n for n, _ in held], [len(w) for _, w in held])),
                "offset": pa.array(offsets.astype(np.int64)),
            }
            if carry_ids:
                ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                columns["ids"] = pa.ListArray.from_arrays(ends, np.concatenate(packed).view(np.int32))
            return pa.RecordBatch.from_pydict(columns)

        for window in windows:
            held.append((number, window))
            number += 1
            if len(held) == 512:
                yield batch()
                held = []
        if held:
            yield batch()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(tokenizer), Packer(size)

        def windows() -> Iterator[list[Piece]]:
            last = np.array([end], encode.dtype)
            for batch in batches:
                for part in slices(batch, "text"):
                    texts = [t or "" for t in part.column("text").to_pylist()]
                    for doc_id, found in zip(part.column("doc_id").to_pylist(), encode.encode(texts)):
                        ids = np.concatenate((np.frombuffer(found, encode.dtype), last))
                        yield from packer.add(Piece(doc_id, 0, len(ids), ids))
            yield from packer.close()

        yield from rows(windows(), TaskContext.get().partitionId() * NUMBERS)

    schema = PACKED if carry_ids else PACKED.removesuffix(", ids array<int>")
    source = narrow(documents, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return source.mapInArrow(run, schema)


def sequences(packed: DataFrame, size: int = WINDOW, pad: int = END_ID) -> DataFrame:
    """Whole sequences from stored pieces: ``ids``, padded with ``pad`` unless a power of two long.

    A sequence has at most ``size`` ids, so no group grows with the data.
    """
    pieces = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(F.flatten(pieces["ids"]).alias("ids"))
    length = F.size("ids")
    padding = F.when(F.bit_count(length) == 1, 0).otherwise(size - length)
    return joined.select(
        "sequence_id", length.cast("long").alias("length"),
        F.concat("ids", F.array_repeat(F.lit(pad), padding.cast("int"))).alias("ids"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(pack(load(spark, sf_dir, "documents"), carry_ids=False), "packed")
