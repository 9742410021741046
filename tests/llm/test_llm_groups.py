"""Near-duplicates, repeated strings, leaks and the pipeline, against plain versions."""

import weakref

import brute
import numpy as np
import pytest
from samples import FOLDER, odd_texts, sentence
from pyspark.sql import functions as F

import corpus_pipeline
from marquee.llm import decontaminate, quality, simhash, suffixes
from marquee.llm.components import components

REPEATS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def prints(df):
    return df.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id")


def test_simhash(odd, given, same):
    same(prints(simhash.grouped(odd)), brute.components(odd_texts()), "*")
    same(prints(simhash.grouped(given[0])), brute.components(given[1]), "*")


def test_simhash_keeps_one(odd, none):
    kept = simhash.keep_one(odd)
    assert kept.schema.names == odd.schema.names
    rows = brute.components(odd_texts())
    assert kept.count() == len({brute.linked([int(r[1], 16) for r in rows])[k] for k in range(len(rows))})
    groups = {r[2] for r in rows if r[2] is not None}
    assert {r.doc_id for r in kept.select("doc_id").collect()} - {None} == groups
    assert simhash.keep_one(none).count() == simhash.grouped(none).count() == 0


def cluster(seed: int, rows: int, center: int = 0x0123456789ABCDEF) -> list[int]:
    rng = np.random.default_rng(seed)
    out = set()
    while len(out) < rows:
        x = center
        for bit in rng.integers(0, 64, rng.integers(0, 5)):
            x ^= 1 << int(bit)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("distance", [1, 2])
@pytest.mark.parametrize("cell", [4, 10_000])
def test_links_of_a_dense_cluster(spark, monkeypatch, distance, cell):
    """Many values close together, among others, linked by pairs or by shared neighbours."""
    monkeypatch.setattr(simhash, "CELL", cell)
    rng = np.random.default_rng(1)
    values = sorted({*cluster(0, 300), *map(int, rng.integers(0, 1 << 64, 300, dtype=np.uint64)), 0, (1 << 64) - 1})
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    found = components(simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), distance)).collect()
    label = {r.node: r.label for r in found}
    groups: dict[int, set] = {}
    for value in signed:
        groups.setdefault(label.get(value, value), set()).add(value)
    want: dict[int, set] = {}
    for value, own in zip(signed, brute.linked(values, distance)):
        want.setdefault(own, set()).add(value)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_thresholds_cover_the_distance():
    """Whatever the allocation, two values within the distance meet in some group."""
    rng = np.random.default_rng(2)
    values = rng.integers(0, 1 << 64, 500, dtype=np.uint64)
    groups = [list(range(0, 20)), list(range(20, 41)), list(range(41, 64))]
    # shares that differ widely, as if some values were very common
    halves = [[[x / x.sum() for x in rng.pareto(0.3, (3, 1 << n))] for n in (len(g) // 2, len(g) - len(g) // 2)]
              for g in groups]
    plan = simhash.Partitions(groups, 10 ** 12, halves, 2)
    chosen = plan.thresholds(values)
    assert (chosen.sum(axis=0) == 3).all() and len({tuple(c) for c in chosen.T}) > 1
    for own, value in zip(chosen.T, values):
        flips = rng.choice(64, 2, replace=False)
        other = value ^ np.uint64(1 << int(flips[0])) ^ np.uint64(1 << int(flips[1]))
        apart = [sum(int(f) in g for f in flips) for g in groups]
        assert any(a < t for a, t in zip(apart, own)), (value, other)


def test_bits_that_go_together_are_grouped():
    share = np.full((64, 64), 250.0)
    np.fill_diagonal(share, 500.0)
    for a, b in ((0, 63), (1, 40)):
        share[a, b] = share[b, a] = 500.0
    groups = simhash.group_bits(share, 1000, 3)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert {len(g) for g in groups} <= {21, 22}
    for pair in ({0, 63}, {1, 40}):
        assert any(pair <= set(g) for g in groups)
    assert simhash.group_count(10_000, 2) == 3 and simhash.group_count(10 ** 11, 2) == 2


def test_components_of_long_chains(spark):
    order = np.random.default_rng(3).permutation(200).tolist()
    links = [(a, b) for a, b in zip(order, order[1:])] + [(1000, 1001), (1001, 1002)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(200), 0), 1000: 1000, 1001: 1000, 1002: 1000}


def test_repeated_bytes(odd, given, none, same):
    same(suffixes.repeated_bytes(odd), brute.repeats(odd_texts()), *REPEATS)
    same(suffixes.repeated_bytes(given[0]), brute.repeats(given[1]), *REPEATS)
    assert suffixes.repeated_bytes(none).count() == suffixes.without_repeats(none).count() == 0


def test_repeated_bytes_of_a_hot_passage(spark, monkeypatch, same):
    """One passage in very many texts: its core has more kinds of pieces than may meet."""
    monkeypatch.setattr(suffixes, "KINDS", 5)
    passage = sentence(1, 200)
    rows = [(k, sentence(100 + k, 20 + k % 7) + passage[k % 3:] + sentence(300 + k, 30)) for k in range(40)]
    rows += [(100 + k, "na" * (300 + k)) for k in range(4)] + [(200, sentence(4, 300_000))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(suffixes.repeated_bytes(df), brute.repeats(rows), *REPEATS)


def test_without_repeats(odd):
    got = suffixes.without_repeats(odd)
    assert got.schema.names == odd.schema.names and got.count() == odd.count()
    want = [None if t is None else kept.decode("utf-8", "ignore")
            for (_, t), (_, kept) in zip(odd_texts(), brute.removed([t for _, t in odd_texts()]))]
    assert sorted(str(r.text) for r in got.select("text").collect()) == sorted(map(str, want))


def test_columns_of_pieces_follow_all_windows():
    """The column-wise order finds the windows that occur twice, whatever stands around them."""
    rng = np.random.default_rng(4)
    for _ in range(200):
        pieces_, starts, length = int(rng.integers(1, 9)), int(rng.integers(1, 4)), 5
        symbols = rng.integers(0, 2, (starts + length - 1, pieces_)).astype(np.int16)
        for k in range(pieces_):
            symbols[: rng.integers(0, starts), k] = -1
            symbols[len(symbols) - rng.integers(0, starts):, k] = -1
        group = np.sort(rng.integers(0, 2, pieces_))
        copies = rng.integers(1, 3, pieces_)
        found = suffixes.repeats(symbols, group, copies, starts, length)
        for start in range(starts):
            seen: dict = {}
            for k in range(pieces_):
                window = tuple(symbols[start:start + length, k])
                seen.setdefault((group[k], window), []).append(k)
            for (_, window), own in seen.items():
                for k in own:
                    assert found[start, k] == (min(window) >= 0 and (len(own) > 1 or copies[k] > 1))


ITEMS = [
    (1, sentence(50, 30), sentence(51, 12)), (2, sentence(52, 9), sentence(53, 3)), (3, "Yes?", "No"),
    (4, None, sentence(54, 40)), (5, None, None), (None, sentence(55, 25), ""), (1, sentence(50, 30), sentence(51, 12)),
]


def planted() -> list[tuple]:
    q, a = ITEMS[0][1], ITEMS[0][2]
    edited = q.split()
    edited[7] = "changed"
    cases = [q + " " + a, a + " " + q, q, a, " ".join(edited) + " " + a, q.upper() + "!!! (" + a.title() + ")",
             ITEMS[1][1] + " -- " + ITEMS[1][2], "yes no", "Yes?", ITEMS[3][2], ITEMS[5][1], None, "",
             q[: len(q) // 2] + sentence(70, 400) + q[len(q) // 2:] + " " + a]
    return [(k, t if t is None else sentence(80 + k, 37 * k) + " " + t + "\n" + sentence(90 + k, 20))
            for k, t in enumerate(cases)] + [(500, None), (None, q + " " + a), (600, q), (600, q)]


@pytest.mark.parametrize("at_once", [2, 1024])
def test_leaks(spark, monkeypatch, at_once):
    monkeypatch.setattr(decontaminate, "PASS_ITEMS", at_once)
    documents = spark.createDataFrame(planted(), "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    items = spark.createDataFrame(ITEMS, "item_id long, question string, answer string")
    got = decontaminate.leaked(documents, items).collect()
    want = brute.leaks(planted(), list(dict.fromkeys(ITEMS)))
    assert {(r.doc_id, r.item_id) for r in got} == set(want)
    assert {k[0] for k in want} >= {0, 4, 6, 9, 10, None} and 2 not in {k[0] for k in want if k[1] == 1}
    kept = decontaminate.keep_clean(documents, items)
    assert kept.schema.names == documents.schema.names
    bad = {k[0] for k in want}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in planted() if d not in bad)


def test_separated_parts_are_found_at_every_offset(spark):
    """Text between question and answer; a longer item of the benchmark changes nothing."""
    question, answer = sentence(200, 40), sentence(201, 19)
    documents = []
    for between in (45, 60, 80, 100):
        middle = sentence(300 + between, between)
        for offset in range(150):
            documents.append((1000 * between + offset, sentence(400 + offset, offset) + " " + question + " "
                              + middle + " " + answer))
    df = spark.createDataFrame(documents, "doc_id long, text string")
    items = [(1, question, answer), (2, sentence(202, 200), sentence(203, 90))]
    found = [{r.doc_id for r in decontaminate.leaked(
        df, spark.createDataFrame(own, "item_id long, question string, answer string")).collect() if r.item_id == 1}
        for own in (items[:1], items)]
    span = 2 * int(1.25 * 59 + 1)
    want = {1000 * between + k for between in (45, 60, 80) for k in range(150) if 59 + between <= span}
    assert found[0] == found[1]
    assert want <= found[0]
    some = [d for d in documents if d[0] % 1000 % 37 == 0]
    assert {d for d, _ in brute.leaks(some, items[:1])} == found[0] & {d for d, _ in some}


def test_one_index_is_held_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PASS_ITEMS", 2)
    build, made, alive = decontaminate.Index.__init__, [], []

    def counted(self, *args):
        alive.append(sum(r() is not None for r in made))
        made.append(weakref.ref(self))
        build(self, *args)

    monkeypatch.setattr(decontaminate.Index, "__init__", counted)
    documents = spark.createDataFrame(planted(), "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, question string, answer string")
    for search in (decontaminate.leaked, decontaminate.keep_clean):
        made.clear()
        search(documents, items)
        assert len(made) > 1
    assert set(alive) == {0}


def test_leaks_in_nothing(spark, none):
    items = spark.createDataFrame(ITEMS, "item_id long, question string, answer string")
    assert decontaminate.leaked(none, items).count() == 0
    assert decontaminate.leaked(spark.createDataFrame(planted(), "doc_id long, text string"), items.limit(0)).count() == 0


def test_pipeline(spark, given):
    rows = [r for r in given[1] if brute.quality(*r, quality.GRAM_LIMITS, quality.LINE_LIMIT)["kept"]]
    rows = [r for r, c in zip(rows, brute.components(rows)) if c[0] == c[2]]
    kept = brute.removed([t for _, t in rows])
    rows = [(d, k.decode("utf-8", "ignore")) for (d, _), (_, k) in zip(rows, kept)]
    items = [tuple(r) for r in decontaminate.halves(spark.read.parquet(f"{FOLDER}/benchmark.parquet")).collect()]
    bad = {d for d, _ in brute.leaks(rows, items)}
    assert bad
    model = brute.sp()
    want = {d: ([1, *model.encode(t), 2], model.decode(model.encode(t))) for d, t in rows if d not in bad}
    got = {r.doc_id: (r.ids, r.text) for r in corpus_pipeline.run(spark, str(FOLDER)).collect()}
    assert got == want


def test_stages_keep_odd_rows(spark, odd, none):
    for documents in (odd, none):
        documents = documents.drop("n")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            documents = stage(spark, documents, str(FOLDER))
        assert set(documents.columns) >= {"doc_id", "text", "lang", "source", "n_chars"}
        corpus_pipeline.encoded(spark, documents, str(FOLDER)).collect()
