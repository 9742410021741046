"""Vector codes, packing and resampling against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from samples import FOLDER, odd_texts

from marquee.llm import packing, resampling, vector_codes

CLASHING = "code string, error string, whole int, part string, same string, rank string"


# --- vector codes ----------------------------------------------------------

def plain_codes(rows, parts, entries, rounds, scale=1024):
    """(vec_id, code, error, label_error) and all entries, one vector after the other."""
    kept = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    usable = sorted((i, v) for i, v, _ in kept if i is not None and v and len(v) % parts == 0)
    width = len(usable[0][1]) // parts if usable else 0
    first = [v for _, v in usable if len(v) == width * parts][:entries]
    books = [[v[p * width:(p + 1) * width] for v in first] for p in range(parts)]

    def nearest(p, v):
        part = v[p * width:(p + 1) * width]
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    fitting = [(v, k) for k, (_, v, _) in enumerate(kept) if width and len(v) == width * parts]
    for _ in range(rounds if width else 0):
        for p in range(parts):
            met = defaultdict(list)
            for v, _ in fitting:
                met[nearest(p, v)[1]].append(v[p * width:(p + 1) * width])
            for k, group in met.items():
                books[p][k] = [sum(c) // len(c) for c in zip(*group)]
    found = {}
    for v, k in fitting:
        each = [nearest(p, v) for p in range(parts)]
        found[k] = "".join(f"{e:02x}" for _, e in each), sum(d for d, _ in each)
    by_label = Counter()
    for k, (_, _, label) in enumerate(kept):
        by_label[label] += found.get(k, (None, 0))[1]
    return [(i, *found.get(k, (None, None)), by_label[label]) for k, (i, _, label) in enumerate(kept)], books


def odd_vectors():
    rng = random.Random(5)
    grid = [[rng.randint(-3, 3) / 4 for _ in range(8)] for _ in range(150)]  # few values, so many ties
    rows = [(k + 3, v, k % 4 or None) for k, v in enumerate(grid)]
    rows += [(None, grid[0], 1), (7, grid[1], None), (7, grid[1], None), (3, grid[9], 2)]
    rows += [(0, None, 1), (1, [1.0, None] * 4, 1), (2, [float("nan")] * 8, 1), (2, [float("-inf")] * 8, 9)]
    return rows + [(900, [0.5] * 4, 1), (901, [], 1), (902, [0.25] * 9, 5)]


def as_table(spark, rows):
    odd = [(*r, "c", "e", 1, "p", "s", None) for r in rows]
    return spark.createDataFrame(odd, f"vec_id long, embedding array<float>, label int, {CLASHING}").repartition(3)


@pytest.mark.parametrize("entries", [1, 40, 256])
def test_vector_codes(spark, same, entries):
    codes, books = vector_codes.compress(as_table(spark, odd_vectors()), 2, entries, 3)
    want, entries_left = plain_codes(odd_vectors(), 2, entries, 3)
    assert books.books == entries_left
    same(vector_codes.with_label_errors(codes), want, "vec_id", "code", "error", "label_error")


def test_vector_codes_of_nothing(spark):
    codes, books = vector_codes.compress(as_table(spark, odd_vectors()).limit(0))
    assert codes.count() == 0 and books.digest() == hashlib.sha256(b"").hexdigest()


def test_vector_codes_decode(spark):
    rows = [(k, [k / 64, 0.5, -1.0, k / 32], 0) for k in range(20)]
    codes, books = vector_codes.compress(as_table(spark, rows), 4, 32, 2)
    decoded = vector_codes.decode(codes, books).select("vec_id", "decoded").collect()
    assert all(np.abs(np.array(r.decoded) - rows[r.vec_id][1]).max() < 0.001 for r in decoded)


@pytest.mark.parametrize("kind", [np.float64, np.int64])
@pytest.mark.parametrize("spread", [2, 400])
def test_tree_gives_the_nearest_of_lowest_index(kind, spread):
    rng = np.random.default_rng(spread)
    points, queries = (rng.integers(-spread, spread + 1, (n, 5)).astype(kind) for n in (256, 9000))
    away = ((queries[:, None] - points) ** 2).sum(axis=2)
    search = vector_codes.Nearest(points)
    index, best = search.find(queries)
    assert (index == away.argmin(axis=1)).all() and (best == away.min(axis=1)).all()
    assert search.looked_at < away.size  # whole subtrees were left out


def test_vectors_too_large():
    with pytest.raises(OverflowError):
        vector_codes.number_type(16, 1 << 40)
    assert vector_codes.number_type(16, 1 << 26) is np.int64


# --- packing ---------------------------------------------------------------

def check_packing(rows, texts, size, tokenizer):
    """Every id once, sequences gapless, padding nowhere but at powers of two."""
    want = Counter((d, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (1,)) for d, t in texts)
    by_sequence, by_document = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
        by_document[r.doc_id, r.doc_tokens].append(r)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        length = 0
        for r in pieces:
            assert r.offset == length and r.length == len(r.ids) > 0
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
            length += r.length
        assert length <= size and length & (length - 1) == 0
    starts = Counter((r.doc_id, r.doc_tokens, r.start, tuple(r.ids)) for r in rows)
    for (doc_id, ids), copies in want.items():
        at = 0
        while at < len(ids):
            fitting = [k for k, n in starts.items() if n > 0 and k[:3] == (doc_id, len(ids), at)
                       and k[3] == ids[at:at + len(k[3])]]
            assert fitting, (doc_id, at)
            for key in fitting[:1]:
                starts[key] -= copies if starts[key] >= copies and len(fitting) == 1 else 1
            at += len(fitting[0][3])
    return by_sequence


def test_packing(spark, odd, given, none):
    tokenizer = brute.bpe()
    plain = [(d, t) for d, t in odd_texts() if d is not None and d != 17]
    documents = spark.createDataFrame(plain, "doc_id long, text string").repartition(2)
    for table, texts, size in ((documents, plain, 64), (given[0], given[1], packing.WINDOW)):
        rows = packing.pack(table, size).collect()
        assert sum(r.length for r in rows) == sum(
            len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in texts)
        check_packing(rows, texts, size, tokenizer)
    assert packing.pack(none).count() == 0
    counts = Counter(r.doc_id for r in packing.pack(odd, 2048).collect() if r.start == 0)
    assert counts == Counter(d for d, _ in odd_texts())


def test_packed_sequences(spark, given):
    packed = packing.pack(given[0], 256).persist()
    whole = {r.sequence_id: r for r in packing.sequences(packed, 256).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id].ids[r.offset:r.offset + r.length] == r.ids
    assert all(len(r.ids) == 256 or len(r.ids) & (len(r.ids) - 1) == 0 for r in whole.values())
    packed.unpersist()


def test_level_has_the_least_sum_of_squares():
    rng, packer, given, got = random.Random(1), packing.Packer(32, 60), 0, 0
    for _ in range(3000):
        length = rng.choice([3, 5, 7, 11, 13, 30])
        def total(level):
            after = packer.levels.copy()
            after[level] -= level > 0
            after[level + length] += 1
            return int((after[1:32] ** 2).sum())
        allowed = [h for h in range(32 - length, -1, -1) if not h or packer.levels[h]]
        assert packer.level(length) == min(allowed, key=lambda h: (total(h), -h))
        given += length
        filled = list(packer.add(packing.Piece(0, 0, length, np.zeros(length, np.int64))))
        assert all(sum(len(p.ids) for p in w) == 32 for w in filled)
        got += 32 * len(filled)
        assert packer.levels[1:32].sum() == sum(map(len, packer.windows.values())) <= 60
    sizes = [sum(len(p.ids) for p in w) for w in packer.close()]
    assert got + sum(sizes) == given
    assert all(s & (s - 1) == 0 for s in sizes) and sum(s < 32 for s in sizes) <= 5


# --- resampling ------------------------------------------------------------

def plain_words(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", folded)


def plain_buckets(text):
    w = plain_words(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def plain_resampling(documents, target):
    found = [(d, plain_buckets(t), len(plain_words(t))) for d, t in documents]
    s, t = Counter(b for _, x, _ in found for b in x), Counter(b for x in target for b in plain_buckets(x))
    all_s, all_t = s.total(), t.total()
    out = []
    for d, held, n_words in found:
        weight = sum(math.floor(1000 * math.log(
            (t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in held)
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(held), weight, score, None, n_words])
    eligible = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(eligible[:5 * len(eligible) // 100], 1):
        r[4] = rank
    return [tuple(r[:5]) for r in out]


def test_resampling(spark, odd, given, none, same):
    target = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    texts = [r.text for r in target.collect()] + [None, ""]
    both = odd.select("doc_id", "text").union(given[0].select("doc_id", "text"))
    extended = target.select("text").union(spark.createDataFrame([(None,), ("",)], "text string"))
    columns = ("doc_id", "n_features", "weight", "score", "rank")
    same(resampling.resample(both, extended), plain_resampling([*odd_texts(), *given[1]], texts), *columns)
    same(resampling.resample(odd, extended), plain_resampling(odd_texts(), texts), *columns)
    assert resampling.resample(none, target).count() == 0
    same(resampling.resample(odd, none), plain_resampling(odd_texts(), []), *columns)


def test_features_of_awkward_texts():
    rng = random.Random(3)
    signs = ["a", "B", "`", "{", "@", "/", "0", "\x7f", "é", "\xa0", "漢", "\x00", "\x01", "\x02", "\x021", " ", "w" * 70]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 12))) for _ in range(2000)] + ["x" * 100_000 + " y"]
    found, counts, n_words = resampling.features([t.encode() for t in texts])
    ends = np.cumsum(counts)
    for text, end, count, n in zip(texts, ends, counts, n_words):
        assert sorted(found[end - count:end].tolist()) == sorted(plain_buckets(text))
        assert n == len(plain_words(text))


def test_ranks_of_equal_rows(spark):
    rows = [(k % 3 or None, 5) for k in range(400)] + [(9, 7)]
    got = resampling.ranked(spark.createDataFrame(rows, "doc_id long, score long"), 200).collect()
    assert sorted(r.rank for r in got if r.rank) == list(range(1, 201))
    assert [r.doc_id for r in sorted((r for r in got if r.rank), key=lambda r: r.rank)] == [9] + [1] * 133 + [2] * 66
