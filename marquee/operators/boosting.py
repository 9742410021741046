"""Boosted regression trees with L1 and L2 penalties and columns drawn per tree.

Every level of a tree is chosen from sums of gradients and rows by (version, node, feature, bin).
Several versions grow side by side, or large ones in turns, each by a team of tasks that keep their rows in
memory, round after round; a small version's team is one task. Where a team has no room or nowhere to meet, its
version grows level by level, a Spark job over cached parts. All sums are of whole numbers, so the trees are the
same either way, and however rows are dealt out.
"""

from __future__ import annotations

import math
import os
import pickle
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, BarrierTaskContext, StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import vocabulary as V
from marquee.session import scratch_path, shared_dir, ship_package
from marquee.sources.tables import materialize

BINS = 256
# Gradients and labels are counted in these units.
UNIT = 1 << 20
# Rows of a version that a task takes at most, some 150 bytes each while they are read. A version with more for
# each of its tasks grows by sums over its parts.
ROWS_PER_TASK = 5_000_000
# Up to so many rows a task, versions grow at once: each has fewer tasks to meet. Beyond, they take turns, so that
# every one has all cores and only its own rows are in memory.
ROWS_AT_ONCE = 1_000_000
# Up to so many rows, another task for a version takes longer to meet than it saves; and the most tasks
# of one, as each reads the sums of all.
ROWS_PER_MEMBER, MEMBERS = 50_000, 32
# Seconds that a task waits for the sums of another.
PATIENCE = 600
# Rounds of one job, where versions grow in tasks: a lost executor costs at most as many. Where
# they grow by sums over parts, predictions are stored anew after as many of the other.
ROUNDS_PER_JOB, ROUNDS_PER_STORE = 500, 50
# Rows of a part, and those that a task has at most where versions grow by sums over parts.
ROWS_PER_PART, ROWS_PER_SHARE = 1 << 18, 8_000_000
# Up to so many tasks the driver adds up itself what they send; that of more is added up by tasks.
SENT = 32
# Rows whose sums are taken at a time where their counts need a pass of their own, and the fewest
# for which both are taken in one.
BLOCK, LEAST_BLOCK = 1 << 16, 1 << 12
# Combinations of bins that features of one code have at most, and the rows that tell which may share one.
COMBINATIONS, SEEN = 1024, 1 << 13
# Rows that all trees are applied to at a time, so few that they stay in a core's cache.
PREDICTED = 1 << 12
# Gains below this are taken for none.
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Boosting:
    """Settings of a fit.

    ``min_gain_total`` is the least reduction of the penalised squared error that a split must
    bring, ``min_rows`` the rows that each side must have. A leaf's value is its residuals' sum,
    less ``l1`` towards 0, over its rows plus ``l2``, times ``rate``. Rows are drawn by a hash of
    their key and the round, columns by a hash of their number and the round.
    """

    rounds: int = 200
    depth: int = 6
    rate: float = 0.1
    row_share: float = 0.8
    column_share: float = 0.8
    min_rows: int = 1
    min_gain_total: float = 0.0
    l1: float = 0.0
    l2: float = 1.0
    seed: int = V.SEED


@dataclass(frozen=True)
class Fit:
    """What to fit: features, settings, and the rows to take, all of them by default."""

    name: str
    features: Sequence[str]
    settings: Boosting = Boosting()
    rows: Column | None = None


@dataclass
class Trees:
    """Fitted trees, all of the same depth, as arrays by tree and place.

    The children of inner place i are 2 i + 1 and 2 i + 2; a row goes right if its feature reaches
    the threshold. Places that do not split send every row left. ``values`` are those of the leaves
    from left to right, and a prediction adds one of each tree to ``base``.
    """

    base: float
    depth: int
    features: np.ndarray
    thresholds: np.ndarray
    gains: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.values)

    def leaves(self, columns: np.ndarray, tree: int) -> np.ndarray:
        """The leaf that each row ends in, from left to right; ``columns`` has a line per feature."""
        n, features, thresholds = columns.shape[1], self.features[tree], self.thresholds[tree]
        values, starts, row = columns.ravel(), features * n, np.arange(n)
        place = np.zeros(n, np.int64)
        if self.depth:  # all rows meet the same split first
            place += columns[features[0]] >= thresholds[0]
            place += 1
        for _ in range(self.depth - 1):
            at = starts.take(place)
            at += row
            right = values.take(at) >= thresholds.take(place)
            place += place
            place += 1
            place += right
        return place - (2 ** self.depth - 1)

    def stages(self, matrix: np.ndarray) -> Iterator[np.ndarray]:
        """Predictions after each round."""
        columns, out = np.ascontiguousarray(matrix.T), np.full(len(matrix), self.base)
        for tree in range(len(self)):
            out = out + self.values[tree].take(self.leaves(columns, tree))
            yield out

    def predict(self, matrix: np.ndarray) -> np.ndarray:
        out = np.full(len(matrix), self.base)
        for first in range(0, len(matrix), PREDICTED):
            for stage in self.stages(matrix[first:first + PREDICTED]):
                out[first:first + PREDICTED] = stage
        return out

    def importances(self, n_features: int) -> np.ndarray:
        """The gain of each feature's splits, as shares of that of all."""
        split = self.gains > 0
        total = np.bincount(self.features[split], self.gains[split], n_features)
        return total / total.sum() if total.sum() else total


# --- bins -------------------------------------------------------------------

def _cells(values: np.ndarray) -> np.ndarray:
    """A whole number that grows with the value and keeps its leading 10 binary digits."""
    bits = (values + 0.0).view(np.int64)  # adding 0 makes -0 and 0 alike
    return (bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))) >> 42


def _matrix(batch: pa.RecordBatch, column: str, width: int) -> np.ndarray:
    flat = pa.ListArray.flatten(batch.column(column)).to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, width)


def cut_points(rows: DataFrame, width: int, most: int = BINS) -> list[np.ndarray]:
    """Where each feature's bins begin, but the first; ``rows`` has the features as ``x``.

    Values are counted by cell: numbers that differ by less than one part in a thousand may share
    one. A feature of at most ``most`` cells has a bin for each, any other bins of equal counts.
    The driver gets the cells' counts, some thousands a feature at most, whatever the rows.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[int, list]] = [{} for _ in range(width)]
        for batch in batches:
            matrix = _matrix(batch, "x", width)
            for k in range(width if len(matrix) else 0):
                values = np.sort(matrix[:, k])
                cells = _cells(values)  # in order, as the values are
                first = np.flatnonzero(np.diff(cells, prepend=cells[0] - 1))
                n = np.diff(first, append=len(cells))
                for cell, low, c in zip(cells[first].tolist(), values[first].tolist(), n.tolist()):
                    known = held[k].setdefault(cell, [low, 0])
                    known[0], known[1] = min(known[0], low), known[1] + c
        rows = [(k, cell, *x) for k, cells in enumerate(held) for cell, x in cells.items()]
        kinds = {"feature": pa.int32(), "cell": pa.int64(), "low": pa.float64(), "n": pa.int64()}
        yield pa.RecordBatch.from_pydict(
            {name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(kinds.items())})

    found = (rows.select("x").mapInArrow(count, "feature int, cell long, low double, n long")
             .groupBy("feature", "cell").agg(F.min("low").alias("low"), F.sum("n").alias("n")).collect())
    cuts = []
    for k in range(width):
        mine = sorted((r.low, r.n) for r in found if r.feature == k)
        if len(mine) > most:
            ends = np.cumsum([n for _, n in mine])
            group = (ends - [n for _, n in mine]) * most // ends[-1]
            mine = [m for i, m in enumerate(mine) if not i or group[i] != group[i - 1]]
        cuts.append(np.array([low for low, _ in mine[1:]]))
    return cuts


def coded(matrix: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """The bin of every value, a byte each; a feature of two bins takes one comparison."""
    out = np.empty(matrix.shape, np.uint8)
    for k, c in enumerate(cuts):
        values = matrix[:, k]
        out[:, k] = values >= c[0] if len(c) == 1 else np.searchsorted(c, values, side="right")
    return out


# --- one tree ---------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit numbers from any."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _turn(settings: Boosting, number: int, purpose: int) -> np.ndarray:
    return _mix(np.array([settings.seed * 1_000_003 + 2 * number + purpose], np.uint64))


def drawn_columns(settings: Boosting, number: int, width: int) -> np.ndarray:
    order = np.argsort(_mix(np.arange(width, dtype=np.uint64) ^ _turn(settings, number, 0)), kind="stable")
    return np.sort(order[:max(1, math.floor(settings.column_share * width + 1e-9))])


def score(gradient: np.ndarray, rows: np.ndarray, settings: Boosting) -> np.ndarray:
    """How much a leaf of these rows lowers the penalised error."""
    shrunk = np.maximum(np.abs(gradient) - settings.l1, 0)
    return np.divide(shrunk * shrunk, rows + settings.l2, out=np.zeros_like(shrunk), where=rows > 0)


def leaf_value(gradient: np.ndarray, rows: np.ndarray, settings: Boosting) -> np.ndarray:
    shrunk = np.sign(gradient) * np.maximum(np.abs(gradient) - settings.l1, 0)
    return -settings.rate * np.divide(shrunk, rows + settings.l2, out=np.zeros_like(shrunk), where=rows > 0)


def best_splits(sums: np.ndarray, sizes: Sequence[int], settings: Boosting):
    """The best split of each node: its gain, feature and bin, and the sums of its left side.

    ``sums`` has gradients and rows by node and bin, the bins of all features side by side. Ties go
    to the first feature, then the lowest bin. A right side begins at a bin that has rows of the node.
    """
    ends = np.cumsum(sizes)
    starts = ends - sizes
    run = np.cumsum(sums, axis=2)
    before = np.concatenate((np.zeros((*sums.shape[:2], 1)), run[:, :, ends[:-1] - 1]), axis=2)
    left = run - np.repeat(before, sizes, axis=2)
    total = left[:, :, ends[0] - 1][:, :, None]
    right = total - left
    gain = score(left[0], left[1], settings) + score(right[0], right[1], settings) - score(
        total[0], total[1], settings)
    least = max(settings.min_rows, 1)
    gain[(left[1] < least) | (right[1] < least)] = -np.inf
    gain[:, ends - 1] = -np.inf
    gain[:, :-1][sums[1][:, 1:] == 0] = -np.inf
    best = gain.argmax(axis=1)
    node = np.arange(len(best))
    feature = np.searchsorted(ends, best, side="right")
    return gain[node, best], feature, best - starts[feature], left[:, node, best], total[:, :, 0]


class Growing:
    """A tree that grows level by level from sums over rows that others add up.

    ``built`` are the nodes of the present level to be added up: of two children the one with fewer
    rows, as the other is what is left of their parent. ``levels`` has, for each level done, the
    feature (-1: none) and the bin that each node splits at.
    """

    def __init__(self, settings: Boosting, sizes: Sequence[int], number: int):
        self.settings, self.number, self.level = settings, number, 0
        self.columns = drawn_columns(settings, number, len(sizes))
        self.sizes = [sizes[k] for k in self.columns]
        self.built, self.parents, self.levels = np.array([0]), None, []
        inner = 2 ** settings.depth - 1
        self.tree = {"feature": np.full(inner, -1), "bin": np.zeros(inner, np.int64), "gain": np.zeros(inner),
                     "value": np.zeros(inner + 1), "error": None}

    @property
    def shape(self) -> tuple[int, int, int]:
        return 2, len(self.built), sum(self.sizes)

    def take(self, added: np.ndarray) -> bool:
        """Split the nodes of a level; whether there is another."""
        s, tree = self.settings, self.tree
        sums = added.astype(np.float64)
        sums[0] /= UNIT
        live = self.built
        if self.parents is not None:
            live = np.sort(np.concatenate((self.built, self.built ^ 1)))
            both = np.empty((2, len(live), sums.shape[2]))
            both[:, np.searchsorted(live, self.built)] = sums
            both[:, np.searchsorted(live, self.built ^ 1)] = self.parents - sums
            sums = both
        gain, which, bin_, left, total = best_splits(sums, self.sizes, s)
        split = (gain > LEAST_GAIN) & (gain >= s.min_gain_total)
        width = 2 ** (s.depth - self.level)
        for node, value in zip(live[~split], leaf_value(total[0], total[1], s)[~split]):
            tree["value"][node * width:(node + 1) * width] = value
        nodes, left = live[split], left[:, split]
        right = total[:, split] - left
        feature, bins = np.full(2 ** self.level + 1, -1), np.zeros(2 ** self.level + 1, np.int64)
        feature[nodes], bins[nodes] = self.columns[which[split]], bin_[split]
        self.levels.append((feature, bins))
        place = 2 ** self.level - 1 + nodes
        tree["feature"][place], tree["bin"][place], tree["gain"][place] = feature[nodes], bins[nodes], gain[split]
        if self.level == s.depth - 1:
            tree["value"][2 * nodes], tree["value"][2 * nodes + 1] = leaf_value(*left, s), leaf_value(*right, s)
        self.built = 2 * nodes + (right[1] < left[1])
        self.parents = sums[:, split]
        self.level += 1
        return self.level < s.depth and len(nodes) > 0


def packed(codes: np.ndarray, sizes: Sequence[int], most: int = COMBINATIONS) -> tuple[list[list[int]], list, list]:
    """Features that share a code, as their bins come in at most ``most`` combinations in these rows.

    Gives the groups of features, the rows' codes by group, and each feature's bin by its group's code.
    A feature goes where it adds the fewest combinations to the first rows.
    """
    groups: list[list[int]] = []
    held: list[np.ndarray] = []
    bins: list[np.ndarray] = [np.zeros(0, np.int64)] * len(sizes)
    counts: list[int] = []
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        own = codes[:, k].astype(np.int64)
        few = [len(np.unique(h[:SEEN] * np.int64(sizes[k]) + own[:SEEN])) for h in held]
        for g in sorted(range(len(groups)), key=lambda g: few[g] - counts[g]):
            if few[g] > most:
                continue
            joint = held[g] * np.int64(sizes[k]) + own
            seen = np.flatnonzero(np.bincount(joint, minlength=1))
            if len(seen) <= most:
                rank = np.zeros(seen[-1] + 1 if len(seen) else 1, np.uint16)
                rank[seen] = np.arange(len(seen))
                held[g], counts[g] = rank[joint], len(np.unique(rank[joint[:SEEN]]))
                for j in groups[g]:
                    bins[j] = bins[j][seen // sizes[k]]
                bins[k] = seen % sizes[k]
                groups[g].append(k)
                break
        else:
            groups.append([k])
            held.append(own.astype(np.uint16))
            bins[k] = np.arange(sizes[k])
            counts.append(len(np.unique(own[:SEEN])))
    return groups, held, bins


class Team:
    """The tasks that have a version's rows among them, and so add up the same sums.

    They run at once and meet in ``folder``: each writes its sums there and reads those of the others.
    """

    def __init__(self, folder: str, member: int, size: int):
        self.folder, self.member, self.size, self.met = folder, member, size, 0
        if size > 1:
            os.makedirs(folder, exist_ok=True)

    def _path(self, meeting: int, member: int) -> str:
        return f"{self.folder}/{meeting}-{member}"

    def added(self, sums: np.ndarray) -> np.ndarray:
        """The sums of all tasks, for each of them."""
        if self.size == 1:
            return sums
        self.met += 1
        own = self._path(self.met, self.member)
        with open(f"{own}.part", "wb") as file:
            file.write(sums.tobytes())
        os.replace(f"{own}.part", own)
        total = sums.copy()
        for member in range(self.size):
            if member != self.member:
                total += np.frombuffer(self._read(self._path(self.met, member)), sums.dtype).reshape(sums.shape)
        if self.met > 1:  # who has come to this meeting has read all of the last one
            os.unlink(self._path(self.met - 1, self.member))
        return total

    def _read(self, path: str) -> bytes:
        until = time.monotonic() + PATIENCE
        while True:
            try:
                with open(path, "rb") as file:
                    return file.read()
            except FileNotFoundError:
                if time.monotonic() > until:
                    raise RuntimeError(f"no sums at {path}: is the shared folder one for all executors?") from None
                time.sleep(0.0005)


class Part:
    """Some rows of one version: their bins, labels, predictions so far, and nodes in a tree.

    ``nodes`` has the rows of each node that may still split, those drawn and the others; ``ended`` the
    rows of those that do not, as if all went left from there.
    """

    def __init__(self, settings: Boosting, sizes: Sequence[int], codes: np.ndarray, label: np.ndarray,
                 key: np.ndarray, watched: np.ndarray, predicted: np.ndarray):
        self.settings, self.sizes = settings, sizes
        self.groups, self.codes, self.bins = packed(codes, sizes)
        self.of = np.zeros(len(sizes), np.int64)  # the group a feature is in
        for g, group in enumerate(self.groups):
            self.of[group] = g
        # a group's codes in the order of a feature's bins, where each bin begins, and which these are
        self.order = [np.argsort(bins, kind="stable") for bins in self.bins]
        found = [np.unique(bins, return_index=True) for bins in (b[o] for b, o in zip(self.bins, self.order))]
        self.starts, self.present = [first for _, first in found], [bins for bins, _ in found]
        self.label, self.key, self.watched, self.predicted = label, key.view(np.uint64), watched, predicted

    def drawn(self, number: int) -> np.ndarray:
        share = self.settings.row_share
        if share >= 1:
            return ~self.watched
        turn, out = _turn(self.settings, number, 1), np.empty(len(self.key), bool)
        for first in range(0, len(out), SEEN):
            mixed = _mix(self.key[first:first + SEEN] ^ turn) >> np.uint64(11)
            out[first:first + SEEN] = mixed < np.uint64(int(share * 2 ** 53))
        return ~self.watched & out

    def begin(self, number: int) -> None:
        self.gradient = np.rint((self.predicted - self.label) * UNIT)
        self.most = np.abs(self.gradient).max(initial=1.0)
        drawn = self.drawn(number)
        self.nodes: dict[int, tuple[np.ndarray, np.ndarray]] = {
            0: tuple(np.flatnonzero(which).astype(np.int32) for which in (drawn, ~drawn))}
        self.ended: dict[int, tuple[np.ndarray, ...]] = {}

    @property
    def here(self) -> np.ndarray:
        """The node of any row, within its level."""
        out = np.zeros(len(self.label), np.int64)
        for node, held in (*self.nodes.items(), *self.ended.items()):
            for rows in held:
                out[rows] = node
        return out

    @property
    def open(self) -> np.ndarray:
        """Whether a row is drawn and in no leaf yet."""
        out = np.zeros(len(self.label), bool)
        for rows, _ in self.nodes.values():
            out[rows] = True
        return out

    def _parted(self, rows: np.ndarray, feature: int, cut: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of the rows go left and which go right."""
        goes = (self.bins[feature] > cut).take(self.codes[self.of[feature]].take(rows))
        return np.compress(~goes, rows), np.compress(goes, rows)  # far faster than by a mask

    def go_down(self, feature: np.ndarray, bins: np.ndarray) -> None:
        """Move rows to the next level."""
        nodes, ended = {}, {2 * node: held for node, held in self.ended.items()}
        for node, (drawn, other) in self.nodes.items():
            if feature[node] < 0:
                ended[2 * node] = drawn, other
            else:
                both = [self._parted(rows, feature[node], bins[node]) for rows in (drawn, other)]
                nodes[2 * node], nodes[2 * node + 1] = zip(*both)
        self.nodes, self.ended = nodes, ended

    def add_up(self, columns: np.ndarray, built: np.ndarray, level: int) -> np.ndarray:
        """Gradients and rows by node and bin, the bins of all columns side by side.

        Where whole numbers leave room for it, a weight holds a row's gradient and, above it, its one,
        so that a pass adds up both. A block has as many rows as there is room for.
        """
        block = min(int(math.sqrt(2.0 ** 51 / self.most)), BLOCK) if self.most < 2.0 ** 51 else 0
        both = block >= LEAST_BLOCK
        block = block if both else BLOCK
        # above all that a block's gradients can add up to
        unit = 2.0 ** math.ceil(math.log2(2 * self.most * block + 1)) if both else 1.0
        # by group, or by column where sums may round, so that they do not depend on what shares a code
        apart = self.most * len(self.label) >= 2.0 ** 53
        wanted = [(int(self.of[k]), int(k)) for k in columns] if apart else [
            (g, None) for g in sorted({int(self.of[k]) for k in columns})]
        held = [np.zeros((2, len(built), len(self.bins[self.groups[g][0]]) if k is None else self.sizes[k]))
                for g, k in wanted]
        for slot, node in enumerate(built.tolist()):
            own = self.nodes[node][0]
            for first in range(0, len(own), block):
                rows = own[first:first + block]
                weight = self.gradient.take(rows)
                if both:
                    weight += unit
                for (g, k), sums in zip(wanted, held):
                    at = self.codes[g].take(rows)
                    if k is not None:
                        at = self.bins[k].take(at)
                    total = np.bincount(at, weight, sums.shape[2])
                    if both:
                        n = np.rint(total / unit)
                        total -= n * unit
                    else:
                        n = np.bincount(at, minlength=sums.shape[2])
                    sums[0, slot] += total
                    sums[1, slot] += n
        if apart:
            return np.concatenate(held, axis=2)
        flat = {g: np.ascontiguousarray(h.reshape(2 * len(built), -1).T) for (g, _), h in zip(wanted, held)}
        out = []
        for k in columns:
            sums = flat[int(self.of[k])]
            if len(self.groups[self.of[k]]) > 1:
                every = np.zeros((self.sizes[k], 2 * len(built)))
                if len(sums):
                    every[self.present[k]] = np.add.reduceat(sums[self.order[k]], self.starts[k], axis=0)
                sums = every
            out.append(sums)
        return np.ascontiguousarray(np.concatenate(out).T).reshape(2, len(built), -1)

    def follow(self, tree: dict) -> None:
        """Bring the predictions up to a tree grown before."""
        added = np.zeros(len(self.label))
        held = [(0, 0, np.arange(len(self.label), dtype=np.int32))]
        while held:
            level, node, rows = held.pop()
            place = 2 ** level - 1 + node
            if level < self.settings.depth and tree["feature"][place] >= 0:
                left, right = self._parted(rows, tree["feature"][place], tree["bin"][place])
                held += [(level + 1, 2 * node, left), (level + 1, 2 * node + 1, right)]
            else:
                added[rows] = tree["value"][node << (self.settings.depth - level)]
        self.predicted = self.predicted + added

    def grow(self, number: int, team: Team) -> dict:
        """A whole tree, where the parts of the team have all rows."""
        growing = Growing(self.settings, self.sizes, number)
        self.begin(number)
        while growing.take(team.added(self.add_up(growing.columns, growing.built, growing.level))):
            self.go_down(*growing.levels[-1])
        # the last splits need no nodes of their own
        feature, bins = growing.levels[-1]
        value = growing.tree["value"].reshape(2 ** growing.level, -1)[:, 0]
        for node, held in (*self.nodes.items(), *self.ended.items()):
            k = feature[node] if node in self.nodes else -1
            for rows in held:
                if k < 0:
                    self.predicted[rows] += value[2 * node]
                else:
                    of_code = np.where(self.bins[k] > bins[node], value[2 * node + 1], value[2 * node])
                    self.predicted[rows] += of_code.take(self.codes[self.of[k]].take(rows))
        return growing.tree

    def error(self) -> tuple[int, int]:
        """The squared error of the watched rows, in units, and their number."""
        far = (self.predicted - self.label)[self.watched]
        return int(np.rint(far * far * UNIT).sum()), int(self.watched.sum())


# --- all rounds -------------------------------------------------------------

@dataclass(frozen=True)
class _Plan:
    """What tasks know of the fits: settings, places and bins of their features, first predictions."""

    settings: list[Boosting]
    places: list[list[int]]
    sizes: list[list[int]]
    bases: list[float]
    width: int
    watches: bool

    def part(self, fit: int, rows: dict[str, np.ndarray], own: np.ndarray) -> Part:
        return Part(self.settings[fit], self.sizes[fit], rows["codes"][own][:, self.places[fit]],
                    rows["label"][own], rows["key"][own], rows["watched"][own], np.full(own.sum(), self.bases[fit]))


_KINDS = {"fit": np.int32, "label": np.float64, "key": np.int64, "watched": bool, "codes": np.uint8}


def _read(batches: Iterator[pa.RecordBatch], width: int, places: Sequence[int] | None = None) -> dict[str, np.ndarray]:
    """All rows of a task as arrays, of their features those at ``places``.

    A column is joined when all batches are there, and its pieces go, so that little is held twice.
    """
    pieces = {n: [np.zeros(0, k)] for n, k in _KINDS.items()}
    pieces["codes"] = [np.zeros((0, width if places is None else len(places)), np.uint8)]
    for batch in batches:
        for name, known in pieces.items():
            column = batch.column(name)
            if name != "codes":
                known.append(column.to_numpy(zero_copy_only=False).copy())
            elif len(column):
                raw = np.frombuffer(column.buffers()[2], np.uint8)[width * column.offset:]
                codes = raw[:width * len(column)].reshape(-1, width)
                known.append(codes.copy() if places is None else codes[:, places])
    return {name: np.concatenate(pieces.pop(name)) for name in list(pieces)}


GROWN = "fit int, feature array<int>, bin array<int>, gain array<double>, value array<double>, error double"


def _slots(spark: SparkSession) -> int:
    """How many tasks can run at once and meet in files, 1 where that is not sure.

    The shared folder must be one that tasks reach by a plain path.
    """
    context, conf = spark.sparkContext, spark.sparkContext.getConf()
    sure = (conf.get("spark.default.parallelism") is None and conf.get("spark.task.cpus", "1") == "1"
            and conf.get("spark.dynamicAllocation.enabled", "false") == "false")
    return context.defaultParallelism if sure and _plain(shared_dir(spark)) else 1


def _plain(folder: str) -> str | None:
    """The path of a folder in a file system of the machines, without its scheme."""
    path = folder.removeprefix("file:")
    return "/" + path.lstrip("/") if path.startswith("/") else None


def _teams(rows: Sequence[int], slots: int, rows_per_member: int) -> list[int]:
    """How many tasks each version gets: one, and of what is left most for those with most rows."""
    teams = [1] * len(rows)
    for _ in range(slots - len(rows)):
        share = [0.0 if n == MEMBERS else own / n for own, n in zip(rows, teams)]
        most = int(np.argmax(share))
        if share[most] <= rows_per_member:
            break
        teams[most] += 1
    return teams


def _turns(rounds: Sequence[int], rows: Sequence[int], slots: int, rows_per_member: int, rows_per_task: int,
           rows_at_once: int) -> tuple[list[list[int]], list[int]]:
    """Which versions grow at once, turn after turn, and those that have too many rows even for a turn of their own.

    Versions that share a turn, if not all do, have as many rounds and about as many rows, as teams that are done
    wait for the others; or there are tasks enough for all. Where no version can have a second task, turns would
    leave cores idle.
    """
    def enough(turn: list[int]) -> bool:
        return len(turn) == 1 or len(turn) * MEMBERS <= slots

    def fits(turn: list[int]) -> bool:
        own, most = [rows[k] for k in turn], rows_per_task if enough(turn) else min(rows_at_once, rows_per_task)
        return all(n <= most * size for n, size in zip(own, _teams(own, slots, rows_per_member)))

    def alike(a: int, b: int) -> bool:
        return rounds[a] == rounds[b] and 2 * rows[b] >= rows[a]

    todo = [k for k, n in enumerate(rounds) if n > 0]
    large = [k for k in todo if not fits([k])]
    todo = [k for k in todo if k not in large]
    if todo and (slots == 1 or fits(todo)):
        return [todo], large
    turns: list[list[int]] = []
    for k in sorted(todo, key=lambda k: -rows[k]):
        shared = [turn for turn in turns if fits([*turn, k]) and (enough([*turn, k]) or alike(turn[0], k))]
        if shared:
            shared[0].append(k)
        else:
            turns.append([k])
    return turns, large


def _in_tasks(rows: DataFrame, plan: _Plan, grown: list[list[dict]], todo: list[int], teams: list[int],
              rounds: int) -> None:
    """Grow up to ``rounds`` more trees of each version, by a team of tasks each."""
    spark = rows.sparkSession
    settled = spark.sparkContext.broadcast((plan, grown))
    places = [(fit, member, size) for fit, size in zip(todo, teams) for member in range(size)]
    begins = np.cumsum([0, *teams])[:-1].tolist()
    together = len(places) > len(todo)
    folder = _plain(scratch_path(spark, "sums")) if together else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, grown = settled.value
        fit, member, size = places[TaskContext.get().partitionId()]
        held = _read(batches, plan.width, plan.places[fit])
        if (held.pop("fit") != fit).any():
            raise RuntimeError("rows of another version")
        part = Part(plan.settings[fit], plan.sizes[fit], **held, predicted=np.full(len(held["label"]), plan.bases[fit]))
        del held
        for tree in grown[fit]:
            part.follow(tree)
        # a task run again must not meet those of the attempt before
        tries = BarrierTaskContext.get().allGather(str(TaskContext.get().taskAttemptId())) if together else [""]
        team = Team(f"{folder}/{tries[0]}-{fit}", member, size)
        first = len(grown[fit])
        for number in range(first, min(first + rounds, plan.settings[fit].rounds)):
            tree = part.grow(number, team)
            total, n = team.added(np.array(part.error())).tolist() if plan.watches else (0, 0)
            if member:
                continue
            error = total / UNIT / max(n, 1) if plan.watches else None
            yield pa.RecordBatch.from_pydict({
                "fit": pa.array([fit], pa.int32()), "feature": pa.array([tree["feature"]], pa.list_(pa.int32())),
                "bin": pa.array([tree["bin"]], pa.list_(pa.int32())),
                "gain": pa.array([tree["gain"]], pa.list_(pa.float64())),
                "value": pa.array([tree["value"]], pa.list_(pa.float64())),
                "error": pa.array([error], pa.float64())})

    at = F.array_position(F.array(*[F.lit(k) for k in todo]), F.col("fit")).cast("int")
    begin, size = (F.element_at(F.array(*[F.lit(n) for n in ns]), at) for ns in (begins, teams))
    own = F.pmod(F.xxhash64(F.monotonically_increasing_id()), size).cast("int")
    # nothing but the dealing above the rows, or tasks without rows would not run
    dealt = rows.filter(F.col("fit").isin(todo)).withColumn("place", begin + own)
    dealt = dealt.repartitionById(len(places), F.col("place"))
    found = dealt.mapInArrow(run, GROWN, barrier=together).withColumn("row", F.monotonically_increasing_id())
    for r in sorted(found.collect(), key=lambda r: r["row"]):
        grown[r.fit].append({"feature": np.array(r.feature), "bin": np.array(r.bin), "gain": np.array(r.gain),
                             "value": np.array(r.value), "error": r.error})
    settled.unpersist()


@dataclass(frozen=True)
class _Asked:
    """A level of a tree to be added up: its number, columns, nodes, and how to get there."""

    number: int
    columns: np.ndarray
    built: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]


def _dealt(rows: DataFrame, plan: _Plan, tasks: int) -> RDD:
    """(fit, part) of all rows, dealt out evenly, each part with rows of one version."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> Iterator[pa.RecordBatch]:
            held = _read(iter(waiting), plan.width)
            for fit in np.unique(held["fit"]).tolist():
                raw = pickle.dumps((fit, plan.part(fit, held, held["fit"] == fit)), pickle.HIGHEST_PROTOCOL)
                yield pa.RecordBatch.from_pydict({"part": pa.array([raw], pa.binary())})

        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= ROWS_PER_PART:
                yield from flush()
                waiting.clear()
        yield from flush()

    return rows.repartition(tasks).mapInArrow(work, "part binary").rdd.map(lambda r: pickle.loads(r.part))


def _merged(a: dict, b: dict) -> dict:
    return {k: a[k] + b[k] if k in a and k in b else a.get(k, b.get(k)) for k in {**a, **b}}


def _added(found: RDD) -> dict:
    """What tasks found by version, added up."""
    return reduce(_merged, found.collect(), {}) if found.getNumPartitions() <= SENT else found.treeReduce(_merged)


def _level(parts: RDD, asked: dict[int, _Asked]) -> dict[int, np.ndarray]:
    """The sums of the present level of every version, in one job.

    A task adds up its own parts and sends a number per version, node and bin.
    """
    def add(own: Iterator[tuple[int, Part]]) -> Iterator[dict[int, np.ndarray]]:
        total: dict[int, np.ndarray] = {}
        for fit, part in own:
            if fit in asked:
                a = asked[fit]
                part.begin(a.number)
                for splits in a.levels:
                    part.go_down(*splits)
                sums = part.add_up(a.columns, a.built, len(a.levels))
                total[fit] = total[fit] + sums if fit in total else sums
        yield total

    return _added(parts.mapPartitions(add))


def _errors(parts: RDD) -> dict[int, float]:
    def measure(own: Iterator[tuple[int, Part]]) -> Iterator[dict[int, np.ndarray]]:
        yield reduce(_merged, ({fit: np.array(part.error(), object)} for fit, part in own), {})

    return {fit: int(total) / UNIT / max(int(n), 1) for fit, (total, n) in _added(parts.mapPartitions(measure)).items()}


def _followed(parts: RDD, trees: dict[int, dict]) -> RDD:
    """The parts of these versions, each brought up to its tree, cached."""
    def follow(own: Iterator[tuple[int, Part]]) -> Iterator[tuple[int, Part]]:
        for fit, part in own:
            if fit in trees:
                part.follow(trees[fit])
                yield fit, part

    return parts.mapPartitions(follow).persist(StorageLevel.MEMORY_AND_DISK)


def _by_levels(parts: RDD, plan: _Plan, grown: list[list[dict]], todo: list[int], rounds: int, more_to_come: bool) -> RDD:
    """Grow up to ``rounds`` more trees of each version, a job per level for all of them.

    Gives the parts with their predictions, for the next rounds; if there are any they are stored in
    the checkpoint folder, so that no more than ``rounds`` trees hang on cached parts.
    """
    old = None
    for left in range(rounds, 0, -1):
        growing = {fit: Growing(plan.settings[fit], plan.sizes[fit], len(grown[fit])) for fit in todo
                   if len(grown[fit]) < plan.settings[fit].rounds}
        more = dict(growing)
        while more:
            sums = _level(parts, {fit: _Asked(g.number, g.columns, g.built, g.levels) for fit, g in more.items()})
            more = {fit: g for fit, g in more.items() if g.take(sums[fit] if fit in sums else np.zeros(g.shape))}
            if old is not None:  # the present parts are cached by now
                old = old.unpersist() and None
        for fit, g in growing.items():
            grown[fit].append(g.tree)
        old, parts = parts, _followed(parts, {fit: g.tree for fit, g in growing.items()})
        last = left == 1 and more_to_come
        if last:
            parts.checkpoint()
        if plan.watches or last:
            for fit, error in _errors(parts).items():
                grown[fit][-1]["error"] = error if plan.watches else None
            old = old.unpersist() and None
    if old is not None:
        old.unpersist()
    return parts


def grow(train: DataFrame, label: str, fits: Sequence[Fit], key: str = "tconst", watch: str | None = None,
         tolerance: float = 0.01, rows_per_task: int = ROWS_PER_TASK, rounds_per_job: int = ROUNDS_PER_JOB,
         rounds_per_store: int = ROUNDS_PER_STORE, rows_per_member: int = ROWS_PER_MEMBER,
         rows_at_once: int = ROWS_AT_ONCE) -> dict[str, Trees]:
    """Fit all of ``fits`` on ``train``; rows without a label are left out, missing features count as 0.

    Rows are cut into bins and stored, a byte per feature, once for every version they are in. Versions
    grow side by side, each by a team of tasks of at least ``rows_per_member`` rows, as cores allow; if a
    task of one had more than ``rows_at_once`` rows, they take turns. Versions that would have more than
    ``rows_per_task`` rows a task even so grow by sums over parts, dealt out over all cores. The trees do
    not depend on which it is.

    ``watch`` names a boolean column that marks rows to measure on; a fit stops once their error
    falls by less than ``tolerance`` of itself, and keeps the rounds up to the least error.
    """
    spark = train.sparkSession
    ship_package(spark)
    names = list(dict.fromkeys(f for fit in fits for f in fit.features))
    number = F.xxhash64(key) if key in train.columns else F.xxhash64(*train.columns)
    member = F.array(*[F.when(F.lit(True) if fit.rows is None else fit.rows, F.lit(k)) for k, fit in enumerate(fits)])
    watched = F.coalesce(F.col(watch), F.lit(False)) if watch else F.lit(False)
    zero = [F.coalesce(F.nanvl(F.col(f"`{n}`").cast("double"), F.lit(0.0)), F.lit(0.0)) for n in names]
    wide = train.filter(F.col(label).isNotNull()).select(
        number.alias("key"), F.col(label).cast("double").alias("label"), watched.alias("watched"),
        F.array_compact(member).alias("fits"), F.array(*zero).alias("x"))
    cuts = cut_points(wide, len(names))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = _matrix(batch, "x", len(names))
            codes = coded(matrix, cuts)
            ends = np.arange(0, codes.size + 1, len(names), dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("fits", "label", "key", "watched")),
                 pa.Array.from_buffers(pa.binary(), len(codes), [None, pa.py_buffer(ends), pa.py_buffer(
                     codes.tobytes())])],
                ["fits", "label", "key", "watched", "codes"])

    rows = wide.mapInArrow(code, "fits array<int>, label double, key long, watched boolean, codes binary").select(
        F.explode("fits").alias("fit"), "label", "key", "watched", "codes")
    rows = materialize(rows, "coded")
    total = rows.filter("not watched").groupBy("fit").agg(
        F.count("*").alias("n"), F.sum(F.rint(F.col("label") * UNIT).cast("long")).alias("total")).collect()
    bases = [0.0] * len(fits)
    for r in total:
        bases[r.fit] = r.total / UNIT / r.n
    places = [[names.index(f) for f in fit.features] for fit in fits]
    plan = _Plan([f.settings for f in fits], places, [[len(cuts[k]) + 1 for k in own] for own in places], bases,
                 len(names), watch is not None)
    counts = [0] * len(fits)
    for r in total:
        counts[r.fit] = r.n
    slots = _slots(spark)
    turns, large = _turns([f.settings.rounds for f in fits], counts, slots, rows_per_member, rows_per_task,
                          rows_at_once)
    grown: list[list[dict]] = [[] for _ in fits]

    def unfinished(todo: list[int]) -> list[int]:
        """Those of ``todo`` that go on; of the others the rounds to keep stay."""
        stopped = {k: _rounds_kept([t["error"] for t in grown[k]], tolerance) for k in todo} if watch else {}
        for k, rounds in stopped.items():
            if rounds is not None:
                del grown[k][rounds:]
        return [k for k in todo if stopped.get(k) is None and len(grown[k]) < fits[k].settings.rounds]

    def left(todo: list[int]) -> int:
        return max(fits[k].settings.rounds - len(grown[k]) for k in todo)

    for todo in turns:
        while todo:
            teams = _teams([counts[k] for k in todo], slots, rows_per_member)
            _in_tasks(rows, plan, grown, todo, teams, min(rounds_per_job, left(todo)))
            todo = unfinished(todo)
    if large:
        context = spark.sparkContext
        if not context.getCheckpointDir():
            context.setCheckpointDir(shared_dir(spark))
        cores = context.defaultParallelism
        tasks = cores * -(-sum(r.n for r in total if r.fit in large) // (cores * ROWS_PER_SHARE))
        parts = _dealt(rows.filter(F.col("fit").isin(large)), plan, tasks).persist(StorageLevel.MEMORY_AND_DISK)
        while large:
            rounds, most = min(rounds_per_store, left(large)), left(large)
            parts = _by_levels(parts, plan, grown, large, rounds, rounds < most)
            large = unfinished(large)
        parts.unpersist()
    return {fit.name: _packed(fit, trees, base, [cuts[k] for k in own])
            for fit, trees, base, own in zip(fits, grown, bases, places)}


def _rounds_kept(errors: Sequence[float], tolerance: float) -> int | None:
    """How many rounds to keep, if the error has stopped falling."""
    best, kept = math.inf, 0
    for number, error in enumerate(errors, 1):
        if number > 1 and best - error < tolerance * max(error, 0.01):
            return kept
        best, kept = error, number
    return None


def _packed(fit: Fit, trees: Sequence[dict], base: float, cuts: Sequence[np.ndarray]) -> Trees:
    inner = 2 ** fit.settings.depth - 1
    out = Trees(base, fit.settings.depth, np.zeros((len(trees), inner), np.int64),
                np.full((len(trees), inner), np.inf), np.zeros((len(trees), inner)),
                np.zeros((len(trees), inner + 1)))
    for k, tree in enumerate(trees):
        at = np.flatnonzero(tree["feature"] >= 0)
        out.features[k, at] = tree["feature"][at]
        out.thresholds[k, at] = [cuts[f][b] for f, b in zip(tree["feature"][at], tree["bin"][at])]
        out.gains[k], out.values[k] = tree["gain"], tree["value"]
    return out
