"""SimHash near-duplicates, found by a generalised pigeonhole over groups of bits."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import load, map_text, numbered, octets, ship_package
from marquee.llm.components import components
from marquee.sources.tables import materialize

SHINGLE = 3
DISTANCE = 2
SEED = 42
BITS = 64
# Cells of the index with more fingerprints than this are linked by shared neighbours instead
# of by pairs, so a dense cluster never gives pairs by the square of its size.
CELL = 48
# Bytes of a text taken at a time, and hashes whose bits are added up at a time.
PART, BLOCK = 1 << 18, 1 << 15
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def parts_of(text: bytes) -> Iterator[bytes]:
    """A text in parts of about PART bytes, cut where white space begins."""
    at = 0
    while len(text) - at > PART:
        found = _SPACE.search(text, at + PART)
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def shingle_hashes(text: bytes, shingle: int) -> Iterator[np.ndarray]:
    """The hashes of a text's shingles, in blocks; a text of fewer words has one shingle, if any."""
    carried: list[bytes] = []
    some = False
    hashed = xxhash.xxh64_intdigest
    for part in parts_of(text):
        words = carried + part.lower().split()
        if len(words) < shingle:
            carried = words
            continue
        line = b" ".join(words)
        stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], stops[:len(words) - shingle]))
        spans = zip(starts.tolist(), (stops[shingle - 1:] - 1).tolist())
        yield np.fromiter((hashed(line[a:b], SEED) for a, b in spans), np.uint64, len(starts))
        carried, some = words[len(words) - shingle + 1:], True
    if carried and not some:
        yield np.array([hashed(b" ".join(carried), SEED)], np.uint64)


def fingerprint(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """One unsigned 64-bit fingerprint per text; 0 for a text without words.

    Set bits are added up for at most BLOCK hashes at a time, or those of one part of a text.
    """
    ones = np.zeros((len(texts), BITS), np.int64)
    sizes = np.zeros(len(texts), np.int64)
    held: list[np.ndarray] = []
    owners: list[int] = []

    def count() -> None:
        begins = np.cumsum([0, *map(len, held[:-1])])
        bits = np.unpackbits(np.concatenate(held).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        np.add.at(ones, owners, np.add.reduceat(bits, begins, axis=0, dtype=np.int32))
        held.clear()
        owners.clear()

    waiting = 0
    for k, text in enumerate(texts):
        for hashes in shingle_hashes(text, shingle):
            held.append(hashes)
            owners.append(k)
            sizes[k] += len(hashes)
            waiting += len(hashes)
            if waiting >= BLOCK:
                count()
                waiting = 0
    if held:
        count()
    most = (2 * ones > sizes[:, None]).astype(np.uint8)
    return np.packbits(most, axis=1, bitorder="little").view("<u8")[:, 0]


def fingerprints(documents: DataFrame, shingle: int = SHINGLE, tell_apart: bool = False) -> DataFrame:
    """``doc_id`` and ``fp`` (64 bits in a long); to tell texts apart, also a hash, ``tie``."""
    source = documents.select("doc_id", "text", *[_tie(F.col("text"))] * tell_apart)
    names = [n for n in source.columns if n != "text"]
    schema = T.StructType([source.schema[n] for n in names] + [T.StructField("fp", T.LongType())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = fingerprint(octets(batch, "text"), shingle).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column(n) for n in names] + [pa.array(found)], [*names, "fp"])

    return map_text(source, work, schema)


def _tie(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit(""))).alias("tie")


@dataclass(frozen=True)
class Partitions:
    """Bits in groups, and what is needed to estimate how many fingerprints share a value.

    ``halves[i][h]`` has, for half ``h`` of group ``i``, the share of fingerprints by value of
    that half, and the shares summed over all values 1 and 2 bits away.
    """

    groups: list[list[int]]
    rows: int
    halves: list[list[list[np.ndarray]]]
    distance: int

    def values(self, fps: np.ndarray, group: int, half: int | None = None) -> np.ndarray:
        """The bits of a group, or of a half of it, packed into the low bits."""
        bits = self.groups[group]
        if half is not None:
            middle = len(bits) // 2
            bits = bits[:middle] if half == 0 else bits[middle:]
        out = np.zeros(len(fps), np.uint64)
        for k, bit in enumerate(bits):
            out |= (fps >> np.uint64(bit) & np.uint64(1)) << np.uint64(k)
        return out

    def masks(self, group: int, radius: int) -> np.ndarray:
        """All changes of at most ``radius`` bits of a group."""
        size = len(self.groups[group])
        found = [sum(1 << k for k in c) for r in range(radius + 1) for c in combinations(range(size), r)]
        return np.array(found, np.uint64)

    def costs(self, fps: np.ndarray, group: int) -> list[np.ndarray]:
        """By threshold, from -1 (not probed) on: probes plus estimated candidates.

        The halves of a group are taken as independent.
        """
        shares = [[t[self.values(fps, group, h)] for t in self.halves[group][h]] for h in (0, 1)]
        out, found, probes = [np.zeros(len(fps))], 0.0, 0
        for radius in range(self.distance + 1):
            found = found + sum(shares[0][r] * shares[1][radius - r] for r in range(radius + 1))
            probes += sum(1 for _ in combinations(range(len(self.groups[group])), radius))
            out.append(probes + self.rows * found)
        return out

    def thresholds(self, fps: np.ndarray) -> np.ndarray:
        """Per fingerprint and group, the threshold plus 1: 0 means that it is not probed.

        The thresholds plus 1 add up to the distance plus 1, so of two fingerprints within the
        distance at least one group differs by no more than its threshold. Among such
        allocations, dynamic programming takes the one of least cost.
        """
        total, m = self.distance + 1, len(self.groups)
        best = np.full((total + 1, len(fps)), np.inf)
        best[0] = 0
        choices = []
        for group in range(m):
            cost = self.costs(fps, group)
            after = np.full_like(best, np.inf)
            choice = np.zeros(best.shape, np.int8)
            for spent in range(total + 1):
                for own in range(spent + 1):
                    tried = best[spent - own] + cost[own]
                    better = tried < after[spent]
                    after[spent][better] = tried[better]
                    choice[spent][better] = own
            best = after
            choices.append(choice)
        out = np.zeros((m, len(fps)), np.int8)
        left = np.full(len(fps), total)
        rows = np.arange(len(fps))
        for group in reversed(range(m)):
            out[group] = choices[group][left, rows]
            left = left - out[group]
        return out


def group_bits(together: np.ndarray, rows: int, m: int) -> list[list[int]]:
    """Bits in ``m`` groups of near equal size, correlated bits in the same one.

    ``together[i, j]`` counts the fingerprints that have both bits. A group starts with the
    bit most correlated with the others left, and takes the bit closest to it each time.
    """
    share = together / max(rows, 1)
    single = np.diag(share)
    spread = np.sqrt(np.maximum(single * (1 - single), 1e-12))
    related = np.abs(share - np.outer(single, single)) / np.outer(spread, spread)
    np.fill_diagonal(related, 0)
    left, groups = list(range(BITS)), []
    for k in range(m):
        size = len(left) // (m - k)
        group = [max(left, key=lambda b: (related[b, left].sum(), -b))]
        while len(group) < size:
            rest = [b for b in left if b not in group]
            group.append(max(rest, key=lambda b: (related[b, group].sum(), -b)))
        left = [b for b in left if b not in group]
        groups.append(sorted(group))
    return groups


def group_count(rows: int, distance: int) -> int:
    """How many groups promise the fewest probes and candidates if bits were independent."""
    def cost(m: int) -> float:
        width, total = BITS // m, distance + 1
        given = [total // m + (k < total % m) for k in range(m)]
        probes = [sum(1 for r in range(t) for _ in combinations(range(width), r)) for t in given]
        return sum(p + rows * p / 2.0 ** width for p in probes)
    return min(range(2, max(distance + 1, 2) + 1), key=cost)


def partitions(distinct: DataFrame, distance: int) -> Partitions:
    """Group the bits and gather the shares, both from all fingerprints.

    The driver gets tables of fixed size: 64 by 64 counts, and one count for each value of
    each half group (at most 4 times 2^16).
    """
    ship_package(distinct.sparkSession)

    def pairs(batches):
        total, rows = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            fps = batch.column("fp").to_numpy().astype("<i8")
            bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            total += np.rint(bits.T.astype(np.float32) @ bits.astype(np.float32)).astype(np.int64)
            rows += len(fps)
        i, j = np.divmod(np.arange(BITS * BITS), BITS)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*i, -1], pa.int32()), pa.array([*j, -1], pa.int32()),
             pa.array([*total.ravel(), rows], pa.int64())], ["i", "j", "n"])

    counted = distinct.select("fp").mapInArrow(pairs, "i int, j int, n long")
    found = counted.groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    together, rows = np.zeros((BITS, BITS)), 0
    for r in found:
        if r.i < 0:
            rows = r.n
        else:
            together[r.i, r.j] = r.n
    groups = group_bits(together, rows, group_count(rows, distance))
    plain = Partitions(groups, rows, [], distance)

    def shares(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            for g, bits in enumerate(groups):
                for h, width in enumerate((len(bits) // 2, len(bits) - len(bits) // 2)):
                    seen = np.bincount(plain.values(fps, g, h).astype(np.int64), minlength=1 << width)
                    sums[g, h] = sums.get((g, h), 0) + seen
        for (g, h), seen in sums.items():
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), g), pa.int32()), pa.array(np.full(len(at), h), pa.int32()),
                 pa.array(at, pa.int64()), pa.array(seen[at], pa.int64())], ["g", "h", "v", "n"])

    histogram = distinct.select("fp").mapInArrow(shares, "g int, h int, v long, n long")
    halves = []
    for bits in groups:
        widths = (len(bits) // 2, len(bits) - len(bits) // 2)
        halves.append([[np.zeros(1 << w)] for w in widths])
    for r in histogram.groupBy("g", "h", "v").agg(F.sum("n").alias("n")).collect():
        halves[r.g][r.h][0][r.v] = r.n / rows
    for group in halves:
        for tables in group:
            exact = tables[0]
            values, width = np.arange(len(exact)), len(exact).bit_length() - 1
            for radius in range(1, distance + 1):
                tables.append(sum(
                    (exact[values ^ sum(1 << k for k in c)]
                     for c in combinations(range(width), radius)), np.zeros(len(exact))))
    return Partitions(groups, rows, halves, distance)


def signatures(distinct: DataFrame, plan: Partitions) -> DataFrame:
    """Index rows (``probe`` false: a fingerprint's own value in each group) and probe rows."""
    everywhere = distinct.sparkSession.sparkContext.broadcast(plan)

    def emit(batches):
        plan = everywhere.value
        for whole in batches:
            for at in range(0, whole.num_rows, 20_000):
                fps = whole.column("fp").slice(at, 20_000).to_numpy().view(np.uint64)
                chosen = plan.thresholds(fps)
                parts: list[tuple[int, bool, np.ndarray, np.ndarray]] = []
                for group in range(len(plan.groups)):
                    values = plan.values(fps, group)
                    parts.append((group, False, values, fps))
                    for t in range(1, plan.distance + 2):
                        own = np.flatnonzero(chosen[group] == t)
                        masks = plan.masks(group, t - 1)
                        parts.append((group, True, (values[own, None] ^ masks).ravel(),
                                      np.repeat(fps[own], len(masks))))
                for group, probe, sigs, owners in parts:
                    if len(sigs):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(sigs), group, np.int32)),
                             pa.array(np.full(len(sigs), probe)),
                             pa.array(sigs.view(np.int64)), pa.array(owners.view(np.int64))],
                            ["part", "probe", "sig", "fp"])

    return distinct.select("fp").mapInArrow(emit, "part int, probe boolean, sig long, fp long")


def links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs (a, b) that connect all fingerprints within ``distance`` of each other.

    Probes meet the index on group and value; pairs are checked on all 64 bits. In a cell of
    more than ``CELL`` fingerprints, and for whoever probes it, pairs are not made: two
    fingerprints differ in at most 2 bits exactly if some 64-bit value lies within 1 bit of
    both, and no value has more than 65 such neighbours. Each is linked to the least of them.
    """
    if distance not in (1, 2):
        raise ValueError("distances of 1 and 2 are supported")
    rows = materialize(signatures(distinct, partitions(distinct, distance)), "signatures")
    cells = materialize(
        rows.filter("not probe").groupBy("part", "sig").count().filter(F.col("count") > CELL)
        .select("part", "sig"), "cells")
    usual = rows.join(cells, ["part", "sig"], "left_anti")
    index = usual.filter("not probe").select("part", "sig", F.col("fp").alias("b"))
    probes = usual.filter("probe").select("part", "sig", F.col("fp").alias("a"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    pairs = probes.join(index, ["part", "sig"]).filter((F.col("a") < F.col("b")) & near).select("a", "b")

    dense = rows.join(cells, ["part", "sig"], "left_semi").select("fp").distinct()
    flips = F.array(F.lit(0), *[F.lit(1 << k if k < 63 else -(1 << 63)) for k in range(BITS)])
    around = dense.select("fp", F.explode(flips).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("around"))
    met = around.groupBy("around").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    if distance == 1:
        met = met.filter(F.array_contains("fps", F.col("around")))
        first = F.col("around")
    else:
        first = F.array_min("fps")
    starred = met.select(first.alias("a"), F.explode("fps").alias("b")).filter("a <> b")
    return pairs.union(starred.distinct())


def fingerprint_groups(documents: DataFrame, shingle: int, distance: int,
                       tell_apart: bool = False) -> tuple[DataFrame, DataFrame]:
    """Stored tables: the fingerprint rows, and each fingerprint's label and component.

    Copies are reduced to one fingerprint before anything is compared, with a map-side
    combine, and only distinct fingerprints are indexed, probed and linked.
    """
    marked = materialize(fingerprints(documents, shingle, tell_apart), "fingerprints")
    distinct = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    labels = components(links(distinct, distance))
    labelled = materialize(distinct.join(labels, distinct.fp == labels.node, "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label")), "labelled")
    least = materialize(
        labelled.groupBy("label").agg(F.min("least").alias("component_id")), "least")
    return marked, materialize(labelled.join(least, "label").select("fp", "label", "component_id"), "groups")


def grouped(documents: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Each document's ``fp`` and ``component_id``, the least doc_id it is linked to.

    Equal fingerprints link, too, and so do chains of links. Texts without words, null ones
    included, share the fingerprint 0 and link like others. Rows repeated with the same doc_id
    stay as many rows; null doc_ids do not count as least, so a group of nothing else has a
    null component. An empty table gives an empty one. Other columns are not read.
    """
    marked, groups = fingerprint_groups(documents, shingle, distance)
    return marked.join(groups, "fp")


def keep_one(documents: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One document of each group, columns unchanged: that with the least doc_id.

    Of rows that repeat it, or if a group has null doc_ids only, any one row stays. Null and empty
    texts are one group. An empty table gives an empty one. Which rows go is settled on narrow rows
    and stored; the documents meet the keys that go, far fewer than those that stay.
    """
    marked, groups = fingerprint_groups(documents, shingle, distance, tell_apart=True)
    names = ["no_id", "id", "tie"]
    no_id, doc_id = F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id")
    keys = marked.join(groups, "fp").select(no_id, doc_id, "tie", "label")
    kept = materialize(
        keys.groupBy("label").agg(F.min(F.struct(*names)).alias("first")).select("first.*"), "kept")
    counted = keys.groupBy(names).count()
    gone = materialize(counted.join(kept, names, "left_anti").select(names), "gone")
    same = materialize(counted.filter("count > 1").join(kept, names, "left_semi").select(names), "same")

    plain, by_name = numbered(documents)
    of = {"doc_id": F.col(by_name["doc_id"]), "text": F.col(by_name["text"])}
    rows = plain.select(
        "*", of["doc_id"].isNull().alias("no_id"), F.coalesce(of["doc_id"], F.lit(0)).alias("id"),
        _tie(of["text"]))
    picked = rows.join(gone, names, "left_anti")
    if same.limit(1).count():
        once = picked.join(same, names, "left_semi").dropDuplicates(names)
        picked = picked.join(same, names, "left_anti").unionByName(once)
    return picked.select(plain.columns).toDF(*documents.columns)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(load(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
