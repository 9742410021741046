"""Repeated byte strings, removed: a collection's suffixes sorted column by column."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import load, numbered, octets, ship_package, slices
from marquee.sources.tables import materialize, materialize_bucketed

LENGTH = 400
# Texts are scanned in runs of about this many bytes; a longer text in several.
SCAN_BYTES = 1 << 18
# Bytes compared to choose an anchor.
GRAM = 65
# Starts that share a piece, at first and where more than KINDS different pieces share a core.
# They divide the possible distances from a start to its anchor; the last must be 1.
WIDTHS = (112, 14, 1)
KINDS = 256
# Pieces whose suffixes are sorted together.
BATCH = 4096
# Texts to look at are picked by a broadcast of their keys, 8 bytes each, if there are no more than
# this; of more, by a join that deals all texts out.
PICKED = 2_000_000

_RANDOM = np.random.default_rng(7)
_BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}

RUNS = "array<struct<low: long, n: int, anchor: long>>"
PIECES = "gid long, pid binary, digest binary, low long, n int, anchor long, lows array<long>"


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 to the 64."""
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            _powers[name] = np.cumprod(factors)
    return _powers["up"][:n], _powers["down"][:n]


class Hashes:
    """Hashes of any substring of some bytes, from sums over prefixes."""

    def __init__(self, raw: np.ndarray):
        up, self.down = powers(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTES[raw] * up[:-1], out=self.sums[1:])

    def of(self, starts, ends) -> np.ndarray:
        x = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ x >> np.uint64(32)


def anchors(raw: np.ndarray, bounds: np.ndarray, length: int = LENGTH):
    """Runs of window starts with a common anchor: text, first start, how many, anchor, key.

    A window's anchor is, of all places in it where GRAM bytes fit, that with the least hash of
    them, the first of equals. It depends on the window's bytes alone, so equal windows have
    their anchors at the same distance. ``bounds`` are the texts' ends in ``raw``, from 0 on.
    """
    empty = np.zeros(0, np.int64)
    count = len(raw) - length + 1
    if count < 1:
        return empty, empty, empty, empty, np.zeros(0, np.uint64)
    hashes = Hashes(raw)
    grams = len(raw) - GRAM + 1
    low = np.uint64((1 << 22) - 1)
    keys = (hashes.sums[GRAM:] - hashes.sums[:grams]) * hashes.down[:grams]
    keys = (keys ^ keys >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    keys ^= keys >> np.uint64(32)
    least = keys & ~low | np.arange(grams, dtype=np.uint64)
    span, width = 1, length - GRAM + 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        rest = width - span
        least = np.minimum(least[: len(least) - rest], least[rest:])
    anchor = (least & low).astype(np.int64)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    whole = np.flatnonzero(text[:count] == text[length - 1:])
    anchor, text = anchor[whole], text[whole]
    first = np.flatnonzero(
        (np.diff(whole, prepend=-2) != 1) | (np.diff(anchor, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
    runs = np.diff(first, append=len(whole))
    return text[first], whole[first], runs, anchor[first], keys[anchor[first]]


def scan(documents: DataFrame, length: int) -> DataFrame:
    """A row for each text and key, with the text's runs of window starts of that key.

    A text that repeats a few bytes over and over has very many runs of few keys, and so few
    rows. A text met again in the same task is not scanned again. Texts longer than SCAN_BYTES
    are scanned in parts that overlap by a window; a run cut in two makes two.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for batch in batches:
            for part in slices(batch, "text", SCAN_BYTES):
                fresh = []
                for digest, text in zip(part.column("digest").to_pylist(), octets(part, "text")):
                    if digest not in met and len(text) >= length:
                        met.add(digest)
                        fresh.append((digest, text))
                if len(met) > 500_000:
                    met = set()
                yield from scanned(fresh)

    def scanned(fresh: list[tuple[bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        if len(fresh) == 1:
            digest, text = fresh[0]
            parts = [([digest], begin, [text[begin:begin + SCAN_BYTES + length - 1]])
                     for begin in range(0, max(len(text) - length + 1, 1), SCAN_BYTES)]
        else:
            parts = [([d for d, _ in fresh], 0, [t for _, t in fresh])] if fresh else []
        for digests, begin, texts in parts:
            bounds = np.cumsum([0, *map(len, texts)])
            text, low, n, anchor, key = anchors(np.frombuffer(b"".join(texts), np.uint8), bounds, length)
            order = np.lexsort((low, key, text))
            text, low, n, anchor, key = (x[order] for x in (text, low, n, anchor, key))
            shift = begin - bounds[text]
            fields = [pa.array(low + shift), pa.array(n, pa.int32()), pa.array(anchor + shift)]
            runs = pa.StructArray.from_arrays(fields, ["low", "n", "anchor"])
            own = np.flatnonzero(np.diff(text, prepend=-1) | (np.diff(key.view(np.int64), prepend=0) != 0))
            ends = np.append(own, len(text)) if len(text) else np.zeros(1, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[own].view(np.int64)), pa.array(digests, pa.binary()).take(pa.array(text[own])),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs)], ["key", "digest", "runs"])

    return documents.select("digest", "text").mapInArrow(work, f"key long, digest binary, runs {RUNS}")


def cut(low: np.ndarray, n: np.ndarray, anchor: np.ndarray, width: int):
    """Runs of starts cut where the distance to the anchor enters another multiple of ``width``.

    Gives the run each part is from, its first start and its number of starts.
    """
    far, near = (anchor - low) // width, (anchor - low - n + 1) // width
    parts = far - near + 1
    source = np.repeat(np.arange(len(low)), parts)
    class_ = np.repeat(far, parts) - (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    begin = np.maximum(low[source], anchor[source] - class_ * width - width + 1)
    end = np.minimum(low[source] + n[source], anchor[source] - class_ * width + 1)
    return source, begin, end - begin


def pieces(texts: DataFrame, width: int, length: int, extra: str = "") -> DataFrame:
    """Cut the runs listed in ``runs`` into pieces of at most ``width`` starts.

    All windows of a piece contain its core, which follows from any one of them. ``gid`` is a
    hash of the core and of its place, ``pid`` a 128-bit digest of all bytes of the piece and of
    its starts. Equal windows are in pieces of the same gid. Equal pieces of a text are one row,
    with all their first starts in ``lows``, unless each has ``extra`` fields of its own.
    """
    names = extra.split()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                for row in range(part.num_rows):
                    raw = part.column("text")[row].as_buffer().to_pybytes()
                    runs = part.column("runs")[row].values
                    low, n, anchor = (runs.field(f).to_numpy().astype(np.int64) for f in ("low", "n", "anchor"))
                    source, begin, count = cut(low, n, anchor, width)
                    at = anchor[source]
                    place = (at - begin) // width
                    # the bytes common to all windows whose distance is in the class
                    core = at - place * width
                    hashes = Hashes(np.frombuffer(raw, np.uint8))
                    gid = hashes.of(core, core - width + 1 + length) ^ (
                        (place * len(WIDTHS) * 1024 + width).astype(np.uint64) * np.uint64(_BASE))
                    pid = [hashlib.blake2b(raw[b:b + c + length - 1], digest_size=16,
                                           salt=int(a - b).to_bytes(8, "little")).digest()
                           for b, c, a in zip(begin.tolist(), count.tolist(), at.tolist())]
                    equal: dict[tuple, list[int]] = {}
                    for k, kind in enumerate(zip(gid.tolist(), pid)):
                        equal.setdefault((*kind, k if names else 0), []).append(k)
                    first = np.array([ks[0] for ks in equal.values()], np.int64)
                    made = [pa.array(gid[first].view(np.int64)), pa.array([pid[k] for k in first], pa.binary()),
                            pa.array([part.column("digest")[row].as_py()] * len(first), pa.binary()),
                            pa.array(begin[first]), pa.array(count[first], pa.int32()), pa.array(at[first]),
                            pa.array([begin[ks] for ks in equal.values()], pa.list_(pa.int64()))]
                    made += [runs.field(f).take(pa.array(source[first])) for f in names]
                    yield pa.RecordBatch.from_arrays(
                        made, ["gid", "pid", "digest", "low", "n", "anchor", "lows", *names])

    kinds = {f.name: f.dataType for f in texts.schema["runs"].dataType.elementType}
    schema = T.StructType.fromDDL(PIECES)
    for name in names:
        schema = schema.add(name, kinds[name])
    return texts.select("digest", F.encode("text", "UTF-8").alias("text"), "runs").mapInArrow(work, schema)


def repeats(symbols: np.ndarray, group: np.ndarray, copies: np.ndarray, starts: int, length: int) -> np.ndarray:
    """Which windows of some aligned pieces occur twice or more in their group.

    ``symbols`` has a row per column of the alignment and a column per piece, -1 where a piece
    has no byte; ``group`` is ascending. Columns are taken from the last to the first, and
    each round puts one symbol of every piece in front of its suffix. The symbols in the order
    of the suffixes behind them are that column's part of the collection's Burrows-Wheeler
    transform; a stable sort by symbol is the step to the next order, and the common prefix
    of neighbours is one more than the least between them before. As equal windows stand in
    equal columns, suffixes of different columns need no place relative to each other.

    A window is repeated if its suffix shares ``length`` bytes with a neighbour's, or if the
    piece stands for several copies.
    """
    pieces_ = symbols.shape[1]
    order = np.arange(pieces_)
    common = np.zeros(pieces_ + 1, np.int32)  # of a suffix and the one before it
    run = np.zeros(pieces_, np.int32)  # bytes of a piece without a gap, from here on
    found = np.zeros((starts, pieces_), bool)
    for column in range(len(symbols) - 1, -1, -1):
        symbol = symbols[column]
        run = np.where(symbol >= 0, run + 1, 0)
        transform = group[order] * 512 + symbol[order] + 1
        if (transform[1:] < transform[:-1]).any():
            step = np.argsort(transform, kind="stable")
            transform, order = transform[step], order[step]
        else:
            step = np.arange(pieces_)
        same = np.zeros(pieces_ + 1, bool)
        same[1:-1] = (transform[1:] == transform[:-1]) & (symbol[order[1:]] >= 0)
        later = np.zeros(pieces_ + 1, np.int32)
        pairs = np.flatnonzero(same)
        if len(pairs):
            between = np.column_stack((step[pairs - 1] + 1, step[pairs] + 1)).ravel()
            later[pairs] = np.minimum.reduceat(common, between)[::2] + 1
        common = later
        if column < starts:
            near = np.maximum(common[:-1], common[1:]) >= length
            found[column, order] = near
            found[column] |= (copies > 1) & (run >= length)
    return found


def decided(rows: DataFrame, width: int, length: int) -> DataFrame:
    """The repeated windows of each piece, as runs of starts relative to its first.

    Pieces of one core are brought together; there are no more than KINDS of them.
    """
    def flush(held: list[dict]) -> pa.RecordBatch:
        columns = width + length - 1
        symbols = np.full((len(held), columns), -1, np.int16)
        offsets = []
        for k, row in enumerate(held):
            distance = row["anchor"] - row["low"]
            offset = distance // width * width + width - 1 - distance
            offsets.append(offset)
            symbols[k, offset:offset + len(row["raw"])] = np.frombuffer(row["raw"], np.uint8)
        group = np.unique([r["gid"] for r in held], return_inverse=True)[1].astype(np.int64)
        by_group = np.argsort(group, kind="stable")
        copies = np.array([r["copies"] for r in held])
        found = repeats(np.ascontiguousarray(symbols[by_group].T), group[by_group], copies[by_group], width, length)
        back = np.empty_like(by_group)
        back[by_group] = np.arange(len(held))
        out = {"gid": [], "pid": [], "found": []}
        for k, row in enumerate(held):
            own = found[offsets[k]:offsets[k] + row["n"], back[k]]
            edges = np.flatnonzero(np.diff(np.concatenate(([0], own.view(np.int8), [0])))).reshape(-1, 2)
            if len(edges):
                out["gid"].append(row["gid"])
                out["pid"].append(row["pid"])
                out["found"].append([{"begin": int(b), "n": int(e - b)} for b, e in edges])
        run = pa.struct([("begin", pa.int64()), ("n", pa.int64())])
        return pa.RecordBatch.from_arrays(
            [pa.array(out["gid"], pa.int64()), pa.array(out["pid"], pa.binary()),
             pa.array(out["found"], pa.list_(run))], ["gid", "pid", "found"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if len(held) >= BATCH and row["gid"] != held[-1]["gid"]:
                    yield flush(held)
                    held = []
                held.append(row)
        if held:
            yield flush(held)

    return (rows.repartition("gid").sortWithinPartitions("gid")
            .mapInArrow(work, "gid long, pid binary, found array<struct<begin: long, n: long>>"))


def with_bytes(chosen: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """Add the bytes of each chosen piece, cut out of its text."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["gid", "pid", "copies", "low", "n", "anchor"]
        for batch in batches:
            for part in slices(batch, "text"):
                for row in range(part.num_rows):
                    raw = part.column("text")[row].as_buffer().to_pybytes()
                    held = part.column("chosen")[row].values
                    spans = zip(held.field("low").to_pylist(), held.field("n").to_pylist())
                    yield pa.RecordBatch.from_arrays(
                        [held.field(f) for f in names]
                        + [pa.array([raw[b:b + n + length - 1] for b, n in spans], pa.binary())], [*names, "raw"])

    by_text = chosen.groupBy("digest").agg(F.collect_list(
        F.struct("gid", "pid", "copies", "low", "n", "anchor")).alias("chosen"))
    return (texts.select("digest", F.encode("text", "UTF-8").alias("text")).join(by_text, "digest")
            .select("text", "chosen").mapInArrow(
                work, "gid long, pid binary, copies long, low long, n int, anchor long, raw binary"))


def decide(found: DataFrame, texts: DataFrame, length: int, level: int = 0) -> DataFrame:
    """(gid, pid, found) for all kinds of pieces that have a repeated window.

    ``found`` has the pieces with ``copies``. Each kind is taken once, with its copies. Where
    a core has more than KINDS kinds, they are cut narrower, so that less of them differs, and
    decided in parts; pieces of one start are equal if their cores are, so this comes to an end
    whatever a core's share of all pieces.
    """
    width = WIDTHS[level]
    kinds = materialize(
        found.groupBy("gid", "pid").agg(
            F.sum("copies").alias("copies"),
            F.min(F.struct("digest", "low", "n", "anchor")).alias("at")), "kinds")
    cores = materialize(
        kinds.groupBy("gid").agg(F.count("*").alias("kinds"), F.sum("copies").alias("total"))
        .filter("total > 1"), "cores")
    kinds = kinds.join(cores, "gid")
    usual = kinds.filter(F.col("kinds") <= KINDS).select("gid", "pid", "copies", "at.*")
    done = decided(with_bytes(usual, texts, length), width, length)
    if not cores.filter(F.col("kinds") > KINDS).limit(1).count():
        return done
    many = materialize(
        kinds.filter(F.col("kinds") > KINDS).select("gid", "pid", "copies", "at.*"), "many")
    runs = many.groupBy("digest").agg(F.collect_list(F.struct(
        "low", "n", "anchor", "copies", F.col("gid").alias("of_gid"), F.col("pid").alias("of_pid"),
        F.col("low").alias("of_low"))).alias("runs"))
    narrower = materialize(
        pieces(texts.select("digest", "text").join(runs, "digest"), WIDTHS[level + 1], length,
               "copies of_gid of_pid of_low"), "narrower")
    parts = materialize(decide(narrower, texts, length, level + 1), "parts")
    whole = narrower.join(parts, ["gid", "pid"]).select(
        F.col("of_gid").alias("gid"), F.col("of_pid").alias("pid"),
        moved("found", F.col("low") - F.col("of_low")).alias("found"))
    return done.union(whole.groupBy("gid", "pid").agg(F.flatten(F.collect_list("found")).alias("found")))


def moved(runs: str, by: Column) -> Column:
    """Runs with their first starts moved."""
    return F.transform(runs, lambda r: F.struct((r.begin + by).alias("begin"), r.n.alias("n")))


def repeated_runs(documents: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """Repeated windows of each distinct text, and those texts.

    ``documents`` has digest and text. Gives (digest, runs) of starts, for texts with any, and
    (digest, text) of the texts that were looked at closely.
    """
    ship_package(documents.sparkSession)
    rows = materialize(scan(documents, length), "anchors")
    # a key has several anchors if the first and last of any text, by hash, are not all the same
    first, last = (F.xxhash64("digest", F.element_at("runs", k)["anchor"]) for k in (1, -1))
    keys = materialize(
        rows.groupBy("key").agg(F.min(F.least(first, last)).alias("a"), F.max(F.greatest(first, last)).alias("b"))
        .filter("a <> b").select("key"), "keys")
    close = materialize(
        rows.join(keys, "key").groupBy("digest").agg(F.flatten(F.collect_set("runs")).alias("runs")), "close")
    # texts are dealt out by digest once, and stay there in the joins that follow
    wanted = documents.select("digest", "text")
    keys = materialize(close.select(F.xxhash64("digest").alias("key")).distinct(), "picked")
    keys = F.broadcast(keys) if keys.count() <= PICKED else keys
    wanted = wanted.withColumn("key", F.xxhash64("digest")).join(keys, "key", "left_semi").drop("key")
    texts = materialize_bucketed(wanted.dropDuplicates(["digest"]).join(close, "digest"), "texts", "digest")
    found = materialize(
        pieces(texts, WIDTHS[0], length).withColumn("copies", F.size("lows").cast("long")), "pieces")
    decisions = materialize(decide(found, texts, length), "decisions")
    starts = found.join(decisions, ["gid", "pid"]).select(
        "digest", F.flatten(F.transform("lows", lambda low: moved("found", low))).alias("runs"))
    return starts.groupBy("digest").agg(F.flatten(F.collect_list("runs")).alias("runs")), texts


def covered(size: int, runs: list[dict], length: int) -> np.ndarray:
    """Spans (begin, end) of the bytes that the windows starting in ``runs`` cover."""
    begin = np.array([r["begin"] for r in runs], np.int64)
    n = np.array([r["n"] for r in runs], np.int64)
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + n + length - 1, -1)
    inside = (np.cumsum(edge[:-1]) > 0).astype(np.int8)
    return np.flatnonzero(np.diff(np.concatenate(([0], inside, [0])))).reshape(-1, 2)


def kept_bytes(raw: bytes, spans: np.ndarray) -> bytes:
    edges = [0, *spans.ravel().tolist(), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))


def with_digest(documents: DataFrame) -> DataFrame:
    """``text`` without nulls, its ``sha256``, and the first half of that as ``digest``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    sha = F.sha2(F.encode(text, "UTF-8"), 256)
    return documents.select(
        "doc_id", text.alias("text"), sha.alias("sha256"), F.unhex(F.substring(sha, 1, 32)).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"))


def spans_by_text(documents: DataFrame, length: int) -> DataFrame:
    """(digest, spans, n_removed, n_spans, kept_sha256) of each text that loses something.

    A text that several documents have is removed whole if it has ``length`` bytes: each of
    its windows also starts in a copy.
    """
    copies = documents.filter(F.col("n_bytes") >= length).groupBy("digest").agg(
        F.count("*").alias("copies"), F.first("n_bytes").alias("n_bytes")).filter("copies > 1")
    copies = materialize(copies.select("digest", "n_bytes"), "copies")
    runs, texts = repeated_runs(documents, length)
    alone = materialize(runs.join(copies, "digest", "left_anti"), "runs")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {"digest": [], "spans": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
            for row in batch.to_pylist():
                raw = row["text"]
                spans = covered(len(raw), row["runs"], length)
                rows["digest"].append(row["digest"])
                rows["spans"].append([{"begin": int(b), "end": int(e)} for b, e in spans])
                rows["n_removed"].append(int((spans[:, 1] - spans[:, 0]).sum()))
                rows["n_spans"].append(len(spans))
                rows["kept_sha256"].append(hashlib.sha256(kept_bytes(raw, spans)).hexdigest())
            yield pa.RecordBatch.from_pydict(rows, pa.schema([
                ("digest", pa.binary()), ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]))

    schema = ("digest binary, spans array<struct<begin: long, end: long>>, n_removed long, n_spans long, "
              "kept_sha256 string")
    partly = texts.select("digest", F.encode("text", "UTF-8").alias("text")).join(alone, "digest") \
        .mapInArrow(work, schema)
    wholly = copies.select(
        "digest", F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end"))).alias("spans"),
        F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        F.sha2(F.lit(b""), 256).alias("kept_sha256"))
    return materialize(partly.union(wholly), "spans")


def repeated_bytes(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """What each document loses and keeps when repeated strings of ``length`` bytes go.

    A byte goes if it lies in such a string that also starts anywhere else, in this document
    or another. Strings are judged on the input. Rows: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256. Null and empty texts have 0 bytes and lose none; repeated rows are copies of
    each other. An empty table gives an empty one.

    Candidates are found by anchors (see ``anchors``): a row for some 170 bytes, most of which
    end at the first count. Only texts that share an anchor are brought together by digest, once.
    """
    rows = with_digest(documents)
    lost = spans_by_text(rows, length)
    own = materialize(rows.select("doc_id", "digest", "n_bytes", "sha256"), "own")
    return own.join(lost.drop("spans"), "digest", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"))


def without_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with repeated bytes taken out of ``text``; other columns unchanged.

    A span may begin or end within a character; what is left of it is dropped. All documents
    stay, some with an empty text. A null text stays null.
    """
    lost = spans_by_text(with_digest(documents), length).select("digest", "spans")
    rows, names = numbered(documents)
    column, plain = names["text"], rows.columns
    digest = F.sha2(F.encode(F.coalesce(F.col(column), F.lit("")), "UTF-8"), 256)
    joined = rows.withColumn("digest", F.unhex(F.substring(digest, 1, 32))).join(lost, "digest", "left").drop("digest")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = plain.index(column)
        for batch in batches:
            for part in slices(batch, column):
                kept = []
                for text, spans in zip(part.column(column).to_pylist(), part.column("spans").to_pylist()):
                    if spans:
                        edges = np.array([(s["begin"], s["end"]) for s in spans], np.int64)
                        text = kept_bytes(text.encode(), edges).decode("utf-8", "ignore")
                    kept.append(text)
                columns = [pa.array(kept, pa.string()) if k == at else part.column(c)
                           for k, c in enumerate(plain)]
                yield pa.RecordBatch.from_arrays(columns, plain)

    return joined.mapInArrow(work, rows.schema).toDF(*documents.columns)


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(load(spark, sf_dir, "documents"))
