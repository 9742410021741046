"""Vectors as short codes: product codebooks whose nearest entries a GNAT finds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import load, narrow, ship_package
from marquee.sources.tables import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
SPLITS, LEAF = 8, 12
QUERIES = 8192
# Widens a distance more than the rounding of its root, of its square's conversion to a double
# and of a difference of two such can change it.
SLACK = 2.0 ** -48
# Squares and their sums below this are whole numbers in doubles.
EXACT = 2 ** 52


def squares(queries: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances, exact: both are whole numbers in a type that holds them."""
    own = np.einsum("ij,ij->i", queries, queries)
    return own[:, None] + np.einsum("ij,ij->i", entries, entries) - 2 * (queries @ entries.T)


def number_type(width: int, largest: int) -> type:
    """Doubles where all squared distances stay exact in them, else 64-bit integers.

    Components so large that a squared distance would leave 64 bits are refused.
    """
    most = width * (2 * largest) ** 2
    if most >= 2 ** 62:
        raise OverflowError("squared distances between these vectors leave 64 bits")
    return np.float64 if most < EXACT else np.int64


@dataclass
class Node:
    """Entries looked at, in ascending order; each may head a subtree of the entries nearest to it.

    ``least[i, j]`` and ``most[i, j]`` bound the distances from entry ``i`` to the members of
    subtree ``j``, rounded outward.
    """

    entries: np.ndarray
    children: list[Node | None]
    least: np.ndarray | None = None
    most: np.ndarray | None = None


def grow(points: np.ndarray, members: np.ndarray) -> Node:
    """A tree over the entries ``members``: split points lie far from each other."""
    if len(members) <= LEAF:
        return Node(members, [])
    away, chosen = squares(points[members], points[members]), [0]
    while len(chosen) < SPLITS:
        nearest = away[chosen].min(axis=0)
        nearest[chosen] = -1
        chosen.append(int(nearest.argmax()))
    chosen.sort()
    rest = np.setdiff1d(np.arange(len(members)), chosen)
    owner = away[chosen][:, rest].argmin(axis=0)
    children, least, most = [], np.zeros((SPLITS, SPLITS)), np.zeros((SPLITS, SPLITS))
    for j in range(SPLITS):
        mine = rest[owner == j]
        children.append(grow(points, members[mine]) if len(mine) else None)
        if len(mine):
            far = np.sqrt(away[chosen][:, mine].astype(np.float64))
            least[:, j], most[:, j] = far.min(axis=1) * (1 - SLACK), far.max(axis=1) * (1 + SLACK)
    return Node(members[chosen], children, least, most)


class Nearest:
    """The nearest entry of one codebook, ties to the lower index.

    A subtree is left out for a query only where its least possible distance, rounded down, lies
    strictly above the distance found, rounded up; equal distances are always looked at, and
    compared as whole numbers.
    """

    def __init__(self, points: np.ndarray):
        self.points, self.root = points, grow(points, np.arange(len(points)))
        self.looked_at = 0

    def find(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry for each query."""
        best = np.full(len(queries), np.iinfo(np.int64).max, np.int64).astype(queries.dtype)
        index = np.full(len(queries), len(self.points))
        for at in range(0, len(queries), QUERIES):
            part = slice(at, at + QUERIES)
            self._visit(self.root, queries[part], np.arange(len(queries[part])), best[part], index[part])
        return index, best

    def _visit(self, node: Node, queries: np.ndarray, rows: np.ndarray, best: np.ndarray,
               index: np.ndarray) -> None:
        away = squares(queries[rows], self.points[node.entries])
        self.looked_at += away.size
        first = away.argmin(axis=1)
        found, which = away[np.arange(len(rows)), first], node.entries[first]
        better = (found < best[rows]) | ((found == best[rows]) & (which < index[rows]))
        best[rows[better]], index[rows[better]] = found[better], which[better]
        if not node.children:
            return
        far = np.sqrt(away.astype(np.float64))
        low, high = far * (1 - SLACK), far * (1 + SLACK)
        bound = np.full((len(rows), SPLITS), -np.inf)
        for i in range(SPLITS):
            np.maximum(bound, low[:, i, None] - node.most[i], out=bound)
            np.maximum(bound, node.least[i] - high[:, i, None], out=bound)
        bound *= 1 - SLACK
        for own in (True, False):  # the subtree of the nearest split point first
            for j, child in enumerate(node.children):
                if child is None:
                    continue
                mine = (first == j) == own
                mine &= bound[:, j] <= np.sqrt(best[rows].astype(np.float64)) * (1 + SLACK)
                if mine.any():
                    self._visit(child, queries, rows[mine], best, index)


@dataclass(frozen=True)
class Codebooks:
    """``books[part][entry]``: whole-number vectors of ``width`` components, as Python integers."""

    books: list[list[list[int]]]
    width: int

    def digest(self) -> str:
        flat = (str(x) for book in self.books for entry in book for x in entry)
        return hashlib.sha256(",".join(flat).encode()).hexdigest()

    def largest(self) -> int:
        return max((abs(x) for book in self.books for entry in book for x in entry), default=0)


def whole_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``label`` and ``whole``, the vector as whole numbers; odd vectors are dropped.

    A vector goes if it is null or has a component that is null, infinite or no number. All is
    done by column functions.
    """
    x = F.col("embedding")
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (narrow(embeddings, "vec_id", "embedding", "label").filter(x.isNotNull() & ~odd)
            .select("vec_id", "label", F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("whole")))


def first_books(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    """Codebooks of the vectors with the smallest ids; equal ids go by their vectors.

    The first of them gives the width. The driver holds ``entries`` vectors.
    """
    cut = vectors.filter((F.size("whole") > 0) & (F.size("whole") % parts == 0) & F.col("vec_id").isNotNull())
    found = cut.orderBy("vec_id", "whole").limit(1).select(F.size("whole").alias("n")).collect()
    width = found[0].n // parts if found else 0
    rows = (cut.filter(F.size("whole") == width * parts).orderBy("vec_id", "whole").limit(entries)
            .select("whole").collect())
    return Codebooks([[r.whole[p * width:(p + 1) * width] for r in rows] for p in range(parts)], width)


def _searches(books: Codebooks, kind: type) -> list[Nearest]:
    return [Nearest(np.array(book, kind)) for book in books.books]


def _parts(batch: pa.RecordBatch, books: Codebooks) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows that have the codebooks' width, and their vectors part by part."""
    held = batch.column("whole")
    size = books.width * len(books.books)
    lengths = np.diff(held.offsets.to_numpy())
    fits = np.flatnonzero(lengths == size) if size else np.array([], np.int64)
    flat = pa.ListArray.flatten(held.take(pa.array(fits))).to_numpy(zero_copy_only=False)
    cube = flat.reshape(len(fits), len(books.books), books.width)
    largest = max(books.largest(), int(np.abs(flat).max()) if len(flat) else 0)
    kind = number_type(books.width, largest)
    return fits, [np.ascontiguousarray(cube[:, p], kind) for p in range(len(books.books))]


class _Searcher:
    """The trees of a task, one set per number type."""

    def __init__(self, books: Codebooks):
        self.books, self.trees = books, {}

    def find(self, part: int, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kind = queries.dtype.type
        if kind not in self.trees:
            self.trees[kind] = _searches(self.books, kind)
        return self.trees[kind][part].find(queries)


def moved(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every part goes to its nearest entry, every entry to the mean of its parts.

    A task adds up its own rows, so a shuffle carries one row per task, entry and component, and
    the driver gets the codebooks' own size.
    """
    ship_package(vectors.sparkSession)
    everywhere = vectors.sparkSession.sparkContext.broadcast(books)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = everywhere.value
        parts, entries = len(books.books), len(books.books[0])
        searcher = _Searcher(books)
        sums = np.zeros((parts, entries, books.width), np.int64)
        counts = np.zeros((parts, entries), np.int64)
        for batch in batches:
            for p, queries in enumerate(_parts(batch, books)[1]):
                index = searcher.find(p, queries)[0]
                counts[p] += np.bincount(index, minlength=entries)
                order = np.argsort(index, kind="stable")
                used, begins = np.unique(index[order], return_index=True)
                if len(used):
                    sums[p, used] += np.add.reduceat(queries[order].astype(np.int64), begins, axis=0)
        part, entry = np.nonzero(counts)
        at = np.tile(np.arange(books.width), len(part))
        rows = [np.repeat(x, books.width) for x in (part, entry, counts[part, entry])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.int32()), pa.array(at, pa.int32()),
             pa.array(sums[part, entry].ravel()), pa.array(rows[2])], ["part", "entry", "at", "total", "n"])

    added = vectors.select("whole").mapInArrow(add, "part int, entry int, at int, total long, n long")
    found = added.groupBy("part", "entry", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    after = [[list(entry) for entry in book] for book in books.books]
    for r in found.collect():
        after[r.part][r.entry][r.at] = r.total // r.n
    everywhere.unpersist()
    return Codebooks(after, books.width)


def coded(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """``code`` and ``error`` of each vector, columns ``vec_id`` and ``label`` beside them.

    A vector whose length is not that of the codebooks has neither.
    """
    ship_package(vectors.sparkSession)
    everywhere = vectors.sparkSession.sparkContext.broadcast(books)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = everywhere.value
        searcher, parts = _Searcher(books), len(books.books)
        for batch in batches:
            fits, pieces = _parts(batch, books)
            codes, total = np.zeros((len(fits), parts), np.uint8), np.zeros(len(fits), np.int64)
            for p, queries in enumerate(pieces):
                index, away = searcher.find(p, queries)
                codes[:, p] = index
                total += away.astype(np.int64)
            digits, errors = codes.tobytes().hex(), total.tolist()
            code, error = [None] * batch.num_rows, [None] * batch.num_rows
            for k, row in enumerate(fits.tolist()):
                code[row], error[row] = digits[2 * parts * k:2 * parts * (k + 1)], errors[k]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").cast(pa.int64()), batch.column("label"), pa.array(code, pa.string()),
                 pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    label = vectors.schema["label"].dataType.simpleString()
    return vectors.mapInArrow(assign, f"vec_id long, label {label}, code string, error long")


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE) -> tuple[DataFrame, Codebooks]:
    """Codes of all vectors, and the codebooks that decode them.

    Null and odd vectors are dropped; ties between entries go to the lower index. Rows with equal
    ids or vectors stay as many rows; null ids give no first entry. With fewer vectors than
    ``entries``, codebooks have as many entries as there are vectors; an empty table gives an empty
    one and empty codebooks. Vectors of another length than the smallest id's, or of a length that
    ``parts`` does not divide, get a null code and error and move no entry. Components whose squared
    distances leave 64 bits raise an error. At most 256 entries, as a code has two digits a part.
    """
    if not 1 <= entries <= 256:
        raise ValueError("codebooks have 1 to 256 entries")
    vectors = materialize(whole_vectors(embeddings, scale), "vectors")
    books = first_books(vectors, parts, entries)
    for _ in range(rounds if books.width else 0):
        books = moved(vectors, books)
    return materialize(coded(vectors, books), "codes"), books


def decode(codes: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """The vectors that codes stand for, as ``decoded``; a null code gives null. Column functions only."""
    pieces = []
    for p, book in enumerate(books.books):
        table = F.array(*[F.array(*[F.lit((x + 0.5) / scale) for x in entry]) for entry in book])
        digits = F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int")
        pieces.append(F.element_at(table, digits + 1))
    return codes.withColumn("decoded", F.concat(*pieces))


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``label_error``, the errors added up over equal labels; null labels count as equal.

    Both sides of the join are stored, so a label that very many rows share can be split.
    """
    sums = materialize(
        codes.groupBy("label").agg(F.coalesce(F.sum("error"), F.lit(0)).alias("label_error")), "label-errors")
    return codes.join(sums.withColumnRenamed("label", "same"), F.col("label").eqNullSafe(F.col("same"))).drop("same")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compress(load(spark, sf_dir, "embeddings"))
    return with_label_errors(codes).select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def _round_sql(k: int) -> str:
    """Assignment to the books of round ``k``, and the books of the next."""
    return f"""
  near{k} AS MATERIALIZED (
    SELECT vec_id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
      SELECT v.vec_id, v.part, b.entry, sum((v.x - b.x) * (v.x - b.x))::BIGINT AS d
      FROM parts v JOIN book{k} b ON v.part = b.part AND v.pos = b.pos GROUP BY ALL) GROUP BY ALL),
  book{k + 1} AS MATERIALIZED (
    SELECT b.part, b.entry, b.pos, coalesce((m.total - ((m.total % m.n) + m.n) % m.n) // m.n, b.x)::BIGINT AS x
    FROM book{k} b LEFT JOIN (
      SELECT part, entry, pos, sum(x)::BIGINT AS total, count(*) AS n
      FROM parts JOIN near{k} USING (vec_id, part) GROUP BY ALL) m USING (part, entry, pos))"""


CODES_SQL = f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, label, embedding, len(embedding) // {PARTS} AS width FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  parts AS MATERIALIZED (
    SELECT vec_id, (i - 1) // width AS part, (i - 1) % width AS pos,
      floor({SCALE} * embedding[i]::DOUBLE)::BIGINT AS x
    FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM kept)),
  book0 AS MATERIALIZED (
    SELECT part, entry, pos, x FROM parts JOIN (
      SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept
      QUALIFY entry < {ENTRIES}) USING (vec_id)),
{",".join(_round_sql(k) for k in range(ROUNDS + 1))},
  found AS (
    SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
    FROM near{ROUNDS} GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) FROM book{ROUNDS}) AS codebooks_sha256
FROM found JOIN kept USING (vec_id)
"""
