"""Boosted trees against a plain version, and however the rows are dealt out."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marquee.operators import boosting
from marquee.operators.boosting import Boosting, Fit, grow
from marquee.sources.tables import materialize

FEATURES = ["a", "b", "c", "d"]


def numbers(n=1500):
    rng = np.random.default_rng(4)
    x = np.column_stack((rng.integers(0, 30, n) / 4, rng.integers(0, 2, n), rng.integers(0, 2, n),
                         np.round(rng.normal(0, 2, n), 1)))
    y = np.round(5 + x[:, 0] / 3 - 2 * x[:, 1] * (x[:, 3] > 0) + rng.normal(0, 0.3, n), 1)
    return x, y


@pytest.fixture(scope="module")
def table(spark):
    x, y = numbers()
    rows = [(f"tt{k}", *map(float, r), float(v), k % 5 == 0) for k, (r, v) in enumerate(zip(x, y))]
    return materialize(spark.createDataFrame(
        rows, "tconst string, a double, b double, c double, d double, y double, held_out boolean").repartition(3), "t")


def plain_fit(x, y, s):
    """Predictions of exact trees that look at every row for every threshold."""
    predicted = np.full(len(y), np.rint(y * boosting.UNIT).sum() / boosting.UNIT / len(y))
    for _ in range(s.rounds):
        g = np.rint((predicted - y) * boosting.UNIT) / boosting.UNIT
        added = np.zeros(len(y))

        def worth(rows):
            return max(abs(g[rows].sum()) - s.l1, 0) ** 2 / (len(rows) + s.l2) if len(rows) else 0

        def place(rows, depth):
            best = (-math.inf,)
            for f in range(x.shape[1]) if depth < s.depth else ():
                for cut in np.unique(x[rows, f])[1:]:
                    left, right = rows[x[rows, f] < cut], rows[x[rows, f] >= cut]
                    if min(len(left), len(right)) >= max(s.min_rows, 1):
                        gain = worth(left) + worth(right) - worth(rows)
                        if gain > best[0] + 1e-9:
                            best = gain, left, right
            if best[0] > boosting.LEAST_GAIN and best[0] >= s.min_gain_total:
                place(best[1], depth + 1)
                place(best[2], depth + 1)
            else:
                total = g[rows].sum()
                added[rows] = -s.rate * math.copysign(max(abs(total) - s.l1, 0), total) / (len(rows) + s.l2)

        place(np.arange(len(y)), 0)
        predicted = predicted + added
    return predicted


@pytest.mark.parametrize("settings", [
    Boosting(rounds=4, depth=3, rate=0.3, row_share=1, column_share=1),
    Boosting(rounds=3, depth=4, rate=0.5, row_share=1, column_share=1, l1=7.5, l2=3.0, min_rows=20, min_gain_total=4.0),
])
def test_trees_equal_a_plain_version(table, settings):
    x, y = numbers()
    trees = grow(table, "y", [Fit("m", FEATURES, settings)])["m"]
    assert np.allclose(trees.predict(x), plain_fit(x, y, settings), atol=1e-9)


def same(a, b):
    return all(np.array_equal(getattr(a, n), getattr(b, n)) for n in ("features", "thresholds", "gains", "values"))


@pytest.mark.parametrize("dealing", [
    {"rounds_per_job": 3}, {"rows_per_task": 400, "rounds_per_store": 3}, {"rows_per_task": 1400}])
def test_trees_do_not_depend_on_the_dealing(table, dealing):
    fits = [Fit("one", FEATURES, Boosting(rounds=7, depth=4, min_gain_total=0.5)),
            Fit("two", FEATURES[1:], Boosting(rounds=5, depth=2, l1=1.0), F.col("a") > 3)]
    whole = grow(table, "y", fits)
    dealt = grow(table.repartition(7), "y", fits, **dealing)
    assert same(whole["one"], dealt["one"]) and same(whole["two"], dealt["two"])
    alone = grow(table.filter("a > 3"), "y", [fits[1]])["two"]
    assert len(whole["one"]) == 7 and len(whole["two"]) == len(alone) == 5


def test_stopping_early_does_not_depend_on_the_dealing(table):
    fit = [Fit("m", FEATURES, Boosting(rounds=60, depth=4, rate=0.8))]
    whole = grow(table, "y", fit, watch="held_out")["m"]
    assert 1 < len(whole) < 60
    assert same(whole, grow(table, "y", fit, watch="held_out", rows_per_task=700)["m"])
    assert same(whole, grow(table, "y", fit, watch="held_out", rounds_per_job=2)["m"])


def test_columns_and_rows_are_drawn_per_tree():
    s = Boosting(column_share=0.5)
    drawn = [tuple(boosting.drawn_columns(s, k, 10)) for k in range(20)]
    assert all(len(d) == 5 for d in drawn) and len(set(drawn)) > 10
    part = boosting.Part(Boosting(row_share=0.8), [2], np.zeros((5000, 1), np.uint8),
                         np.zeros(5000), np.arange(5000) * 7919, np.zeros(5000, bool), np.zeros(5000))
    shares = [part.drawn(k).mean() for k in range(5)]
    assert all(abs(x - 0.8) < 0.03 for x in shares) and (part.drawn(0) != part.drawn(1)).any()


def test_bins_of_equal_counts(spark):
    many = spark.range(20_000).select(F.array(F.sqrt(F.col("id").cast("double")), F.lit(-1.0), F.col("id") % 3 - 1.0).alias("x"))
    cuts = boosting.cut_points(many, 3, 16)
    assert len(cuts[0]) == 15 and len(cuts[1]) == 0 and cuts[2].tolist() == [0, 1]
    counts = np.diff(np.searchsorted(np.sqrt(np.arange(20_000)), [0, *cuts[0], 1e9]))
    assert counts.min() > 1000 and counts.max() < 1500
    cells = boosting._cells(np.array([-2.0, -1e-9, 0.0, 1e-9, 1.0, 1.5, 3e300]))
    assert (np.diff(cells) > 0).all() and boosting._cells(np.array([-0.0]))[0] == cells[2]


def test_thresholds_are_values_of_the_node(spark):
    """Not of rows elsewhere, though these would split the node's rows alike."""
    rows = [(k, float(a), float(b), float(y)) for k, (a, b, y) in enumerate(
        [(0, 1, 1), (0, 1, 1), (0, 4, 3), (0, 4, 3), (1, 2, 9), (1, 3, 9), (1, 3, 9), (1, 2, 9)])]
    table = spark.createDataFrame(rows, "tconst long, a double, b double, y double")
    s = Boosting(rounds=1, depth=2, rate=1.0, row_share=1, column_share=1, l2=0.0)
    trees = grow(table, "y", [Fit("m", ["a", "b"], s)])["m"]
    assert trees.features[0].tolist() == [0, 1, 0] and trees.thresholds[0][:2].tolist() == [1, 4]


def test_nothing_to_learn_from(spark, table):
    s = Boosting(rounds=3, depth=2)
    assert grow(table.limit(0), "y", [Fit("m", FEATURES, s)])["m"].predict(np.zeros((2, 4))).tolist() == [0, 0]
    constant = grow(table.withColumn("y", F.lit(3.0)), "y", [Fit("m", FEATURES, s)])["m"]
    assert (constant.predict(numbers()[0]) == 3).all() and not constant.importances(4).any()
    blank = table.withColumn("a", F.lit(None).cast("double")).withColumn("d", F.lit(float("nan")))
    assert len(grow(blank, "y", [Fit("m", FEATURES, s)])["m"]) == 3


@pytest.mark.parametrize("scale", [1, 1e9])
def test_features_that_share_a_byte_add_up_as_apart(scale):
    """Also where gradients leave no room for counts beside them."""
    rng, n, sizes = np.random.default_rng(2), 20_000, [2, 3, 200, 2, 256, 1, 20, 2]
    codes = np.column_stack([rng.integers(0, s, n) for s in sizes]).astype(np.uint8)
    label = np.round(rng.uniform(1, 10, n), 1) * scale
    part = boosting.Part(Boosting(row_share=0.7), sizes, codes, label, np.arange(n) * 7919,
                         np.zeros(n, bool), np.full(n, 5.0 * scale))
    assert len(part.groups) < len(sizes) and sorted(sum(part.groups, [])) == list(range(len(sizes)))
    part.begin(0)
    gradient, drawn = part.gradient.copy(), part.open.copy()
    part.go_down(np.array([2, -1]), np.array([90, 0]))
    part.go_down(np.array([6, -1, -1]), np.array([4, 0, 0]))
    node = np.where(codes[:, 2] > 90, 2, codes[:, 6] > 4)
    assert (part.here == node).all() and (part.open == (drawn & (node < 2))).all()
    columns = np.array([0, 2, 3, 4, 6, 7])
    found = part.add_up(columns, np.array([0, 1]), 2)
    wanted = [np.array([[np.bincount(codes[rows, k], w[rows], sizes[k]) for rows in (
        np.flatnonzero(drawn & (node == x)) for x in (0, 1))] for w in (gradient, np.ones(n))]) for k in columns]
    assert np.array_equal(found, np.concatenate(wanted, axis=2))


def test_levels_are_added_up_on_all_cores_from_cached_parts(spark, table, monkeypatch):
    """Rows are dealt out over all cores once, not read again for every level."""
    seen, level = [], boosting._level
    monkeypatch.setattr(boosting, "_level", lambda parts, *rest: (seen.append(parts), level(parts, *rest))[1])
    grow(table, "y", [Fit("m", FEATURES, Boosting(rounds=2, depth=2))], rows_per_task=1400)
    assert len(seen) >= 2 and all(p.getNumPartitions() >= spark.sparkContext.defaultParallelism for p in seen)
    assert len({id(p) for p in seen}) == 2


def test_versions_grow_by_teams_of_tasks(spark, table, monkeypatch, tmp_path):
    """The rows of a version are with several tasks, which meet in files and clear them away."""
    seen, in_tasks = [], boosting._in_tasks
    monkeypatch.setattr(boosting, "_in_tasks", lambda *rest: (seen.append(rest[4]), in_tasks(*rest))[1])
    monkeypatch.setattr(boosting, "scratch_path", lambda spark, label: f"file:{tmp_path}/{label}-{len(seen)}")
    fits = [Fit("one", FEATURES, Boosting(rounds=7, depth=4, min_gain_total=0.5)),
            Fit("two", FEATURES[1:], Boosting(rounds=4, depth=2, l1=1.0), F.col("a") > 3)]
    whole = grow(table, "y", fits, watch="held_out", tolerance=-1e9)
    dealt = grow(table, "y", fits, watch="held_out", tolerance=-1e9, rows_per_member=300, rounds_per_job=5)
    assert seen[0] == [1, 1] and seen[-2:] == [[2, 2], [4]]
    assert all(same(whole[n], dealt[n]) for n in whole)
    left = [f for f in tmp_path.rglob("*") if f.is_file()]
    assert len(left) == 8


def test_teams_by_rows():
    assert boosting._teams([0], 8, 100) == [1] and boosting._teams([900, 100], 8, 100) == [7, 1]
    assert boosting._teams([900, 900, 100], 6, 100) == [3, 2, 1] and boosting._teams([10**9], 999, 100) == [boosting.MEMBERS]
    assert boosting._teams([500] * 9, 8, 100) == [1] * 9


def test_large_versions_take_turns(spark, table, monkeypatch):
    """Versions that do not fit side by side grow one after another by all tasks, not by a job for every level."""
    seen, in_tasks = [], boosting._in_tasks
    monkeypatch.setattr(boosting, "_in_tasks", lambda *rest: (seen.append(rest[3:5]), in_tasks(*rest))[1])
    fits = [Fit("one", FEATURES, Boosting(rounds=3, depth=3)), Fit("two", FEATURES[1:], Boosting(rounds=3, depth=2)),
            Fit("three", FEATURES[:2], Boosting(rounds=2, depth=2), F.col("a") > 3)]
    whole = grow(table, "y", fits)
    assert seen == [([0, 1, 2], [1, 1, 1])] and not seen.clear()
    monkeypatch.setattr(boosting, "_by_levels", None)
    turns = grow(table.repartition(5), "y", fits, rows_per_task=500, rows_per_member=200)
    assert seen == [([0], [4]), ([1], [4]), ([2], [4])] and not seen.clear()
    assert all(same(whole[n], turns[n]) for n in whole)
    turns = grow(table, "y", fits, rows_at_once=800, rows_per_member=400)
    assert seen == [([0, 1], [2, 2]), ([2], [3])] and all(same(whole[n], turns[n]) for n in whole)


def test_turns_by_rows():
    def turns(rounds, rows, slots, per_task=500, at_once=100):
        return boosting._turns(rounds, rows, slots, 10, per_task, at_once)

    assert turns([2, 5, 5], [300, 300, 100], 8) == ([[0, 1, 2]], [])
    assert turns([2, 5, 5, 5, 5], [2000, 2000, 350, 2000, 350], 8) == ([[0], [1], [3], [2, 4]], [])
    assert turns([5, 5], [4001, 90], 8) == ([[1]], [0]) and turns([0, 5], [9000, 0], 8) == ([[1]], [])
    # more cores than one version can use
    assert turns([2, 5, 5], [9000] * 3, 96) == ([[0, 1, 2]], []) and turns([2, 5, 5], [9000] * 3, 64) == ([[0, 1], [2]], [])
    # no teams: all that fit into a task at once, whatever their rounds
    assert turns([2, 5, 5], [300, 501, 400], 1) == ([[0, 2]], [1])
    assert turns([], [], 8) == ([], []) and turns([5], [30], 8, 20, 100) == ([[0]], [])


def test_rows_of_a_task_are_read_with_its_own_features():
    codes = np.random.default_rng(1).integers(0, 256, (7, 3)).astype(np.uint8)
    whole = pa.RecordBatch.from_pydict({
        "fit": pa.array([0] * 7, pa.int32()), "label": np.arange(7.0), "key": np.arange(7), "codes": [bytes(c) for c in codes],
        "watched": [k == 2 for k in range(7)]})
    for cut in ([whole], [whole.slice(0, 3), whole.slice(3, 0), whole.slice(3)]):
        held = boosting._read(iter(cut), 3, [2, 0])
        assert held["codes"].tolist() == codes[:, [2, 0]].tolist() and held["label"].tolist() == list(range(7))
        assert held["watched"].nonzero()[0].tolist() == [2] and boosting._read(iter(cut), 3)["codes"].tolist() == codes.tolist()
    assert boosting._read(iter([]), 3, [2, 0])["codes"].shape == (0, 2) and boosting._read(iter([]), 3)["key"].dtype == np.int64


def test_sums_meet_in_files_of_the_shared_folder_only(spark, monkeypatch):
    assert boosting._plain("file:///a/b") == boosting._plain("file:/a/b") == boosting._plain("/a/b") == "/a/b"
    assert boosting._plain("hdfs://host/a") is None and boosting._plain("viewfs:///a") is None
    assert boosting._slots(spark) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(boosting, "shared_dir", lambda spark: "hdfs://host/a")
    assert boosting._slots(spark) == 1


def test_features_that_follow_from_another_share_its_code():
    """However many combinations their bins could come in, only those of the rows count."""
    rng, n = np.random.default_rng(3), 30_000
    year, other = rng.integers(0, 140, n), rng.integers(0, 256, n)
    codes = np.column_stack([year, year // 10, *[year > k for k in range(9, 130, 10)], other]).astype(np.uint8)
    sizes = [140, 14, *[2] * 13, 256]
    groups, held, bins = boosting.packed(codes, sizes)
    assert sorted(map(sorted, groups)) == [list(range(15)), [15]]
    for group, code in zip(groups, held):
        assert all(np.array_equal(bins[k][code], codes[:, k]) for k in group)
    late = codes.copy()
    late[-2000:, 14] ^= 1  # combinations that the first rows do not show
    groups, held, bins = boosting.packed(late, sizes)
    assert all(len(bins[k]) <= boosting.COMBINATIONS for k in range(len(sizes)))
    assert all(np.array_equal(bins[k][held[g]], late[:, k]) for g, group in enumerate(groups) for k in group)


def test_predictions_of_blocks_equal_those_of_single_rows():
    rng, n = np.random.default_rng(5), boosting.PREDICTED + 100
    x = rng.integers(0, 9, (n, 3)).astype(float)
    trees = boosting.Trees(1.5, 2, rng.integers(0, 3, (4, 3)), rng.integers(0, 9, (4, 3)).astype(float),
                           np.ones((4, 3)), rng.normal(0, 1, (4, 4)))

    def plain(row):
        out = trees.base
        for f, t, v in zip(trees.features, trees.thresholds, trees.values):
            place = 0
            while place < 3:
                place = 2 * place + 1 + (row[f[place]] >= t[place])
            out += v[place - 3]
        return out

    assert trees.predict(x).tolist() == [plain(r) for r in x]
    assert np.array_equal(list(trees.stages(x))[-1], trees.predict(x))


def test_bins_by_one_comparison_equal_a_search():
    values = np.array([[-np.inf, 0.0], [-0.0, 1.0], [0.0, 2.5], [0.5, 3.0], [1.0, -7.0], [np.inf, np.inf]])
    cuts = [np.array([0.0]), np.array([1.0, 2.0, 3.0]), np.array([])]
    matrix = np.column_stack([values, values[:, 0]])
    found = boosting.coded(matrix, cuts)
    assert found.dtype == np.uint8
    assert found.T.tolist() == [np.searchsorted(c, matrix[:, k], side="right").tolist() for k, c in enumerate(cuts)]


@pytest.mark.parametrize("depth", [0, 1, 3])
def test_leaves_of_columns_equal_a_walk(depth):
    rng = np.random.default_rng(depth)
    inner, matrix = 2 ** depth - 1, np.where(rng.random((50, 4)) < 0.1, np.nan, rng.integers(0, 9, (50, 4)))
    trees = boosting.Trees(0.5, depth, rng.integers(0, 4, (3, inner)), rng.integers(0, 9, (3, inner)).astype(float),
                           np.ones((3, inner)), rng.random((3, inner + 1)))
    for tree in range(3):
        for row, leaf in zip(matrix, trees.leaves(np.ascontiguousarray(matrix.T), tree)):
            place = 0
            while place < inner:
                place = 2 * place + 1 + int(row[trees.features[tree, place]] >= trees.thresholds[tree, place])
            assert leaf == place - inner
