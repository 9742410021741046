"""Importance resampling towards a target: hashed n-gram features scored by log ratios."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm.common import load, map_text, narrow, octets, segment_sums, ship_package
from marquee.sources.tables import materialize

BUCKETS = 10_000
GRAM = 3
MIN_WORDS = 20
SHARE_PCT = 5
SEED = 42
GAIN_SCALE = 1000
# Longer words are known to the automaton by a short name, so its size follows the number of
# distinct words and not their length.
LONGEST = 48

# Letters and digits stay, A-Z in lower case, and so does every byte of a character above ASCII;
# all else parts words.
_FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_LONG = re.compile(rb"[^ ]{%d,}" % (LONGEST + 1))
_BREAK = b"\x01"  # between documents; not a byte of any word
_POLYNOMIAL = 0xEDB88320


# --- checksums of joined strings ------------------------------------------

def _byte_step() -> np.ndarray:
    """What one zero byte makes of each bit of a checksum's state."""
    out = np.empty(32, np.uint32)
    for bit in range(32):
        state = 1 << bit
        for _ in range(8):
            state = (state >> 1) ^ (_POLYNOMIAL if state & 1 else 0)
        out[bit] = state
    return out


def _apply(step: np.ndarray, states: np.ndarray) -> np.ndarray:
    out = np.zeros_like(states)
    for bit in range(32):
        out ^= np.where(states >> np.uint32(bit) & np.uint32(1), step[bit], np.uint32(0)).astype(np.uint32)
    return out


@lru_cache(maxsize=4096)
def _shift(length: int) -> np.ndarray:
    """For each byte of a checksum, what ``length`` zero bytes behind it make of it: 4 x 256."""
    step, result = _byte_step(), np.uint32(1) << np.arange(32, dtype=np.uint32)
    while length:
        if length & 1:
            result = _apply(step, result)
        step = _apply(step, step)
        length >>= 1
    values = np.arange(256, dtype=np.uint32)
    return np.stack([_apply(result, values << np.uint32(8 * k)) for k in range(4)])


def joined(first: np.ndarray, second: np.ndarray, kinds: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """CRC-32 of strings put together, from the CRC-32 of each.

    ``kinds`` names, for each pair, the row of ``shifts`` for the second string's length.
    """
    flat, base = shifts.reshape(-1), kinds.astype(np.int64) * 1024
    out = second.copy()
    for k in range(4):
        out ^= flat[base + (256 * k + (first >> np.uint32(8 * k) & np.uint32(255)).astype(np.int64))]
    return out


# --- features of a slice of texts -----------------------------------------

def features(texts: list[bytes], gram: int = GRAM, buckets: int = BUCKETS) -> tuple[np.ndarray, ...]:
    """The bucket of every feature, those of one text after the other; features and words per text.

    The distinct words of the texts, each between two spaces, make up an Aho-Corasick dictionary;
    a word's payload is its number, for the CRC-32 of the word, of the word behind a space, and its
    length. One scan over all texts gives the payloads in order. Payloads that follow each other in
    a text are composed to the checksum of two words, then of three.
    """
    import ahocorasick

    folded = [t.translate(_FOLDED) for t in texts]
    named: dict[bytes, bytes] = {}

    def name(found: re.Match) -> bytes:
        return named.setdefault(found[0], b"\x02%d" % len(named))

    words = [(_LONG.sub(name, t) if len(t) > LONGEST else t).split() for t in folded]
    known = set().union(*words)
    if not known:
        return np.empty(0, np.int64), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    meant = {short: word for word, short in named.items()}
    tree = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    tree.add_word(" \x01 ", 0)
    crc, spaced, lengths = [0], [0], [0]
    start = zlib.crc32(b" ")
    for number, word in enumerate(known, 1):
        tree.add_word(f" {word.decode('latin-1')} ", number)
        whole = meant.get(word, word) if word[0] == 2 else word
        crc.append(zlib.crc32(whole))
        spaced.append(zlib.crc32(whole, start))
        lengths.append(len(whole) + 1)
    tree.make_automaton()
    line = b" " + (b" " + _BREAK + b" ").join([b" ".join(w) for w in words]) + b" "
    line = re.sub(b" {2,}", b" ", line).decode("latin-1")
    found = np.fromiter(map(itemgetter(1), tree.iter(line)), np.int64)
    del tree, line

    breaks = found == 0
    document = np.cumsum(breaks)[~breaks]
    found = found[~breaks]
    n_words = np.bincount(document, minlength=len(texts))
    crc, spaced = np.array(crc, np.uint32), np.array(spaced, np.uint32)[found]
    sizes, kinds = np.unique(lengths, return_inverse=True)
    shifts, kinds = np.stack([_shift(int(n)) for n in sizes]), kinds[found]
    held = crc[found]
    parts, owners = [held % buckets], [document]
    for n in range(1, gram):
        if len(found) <= n:
            break
        held = joined(held[:-1], spaced[n:], kinds[n:], shifts)
        within = document[:-n] == document[n:]
        parts.append(held[within] % buckets)
        owners.append(document[n:][within])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return (np.concatenate(parts)[order].astype(np.int64), np.bincount(owner, minlength=len(texts)), n_words)


def featured(texts: DataFrame, gram: int = GRAM, buckets: int = BUCKETS, key: str | None = "doc_id") -> DataFrame:
    """``key``, ``n_words`` and ``buckets``, the features' buckets as 16-bit numbers, little endian.

    Null and empty texts, and texts without words, have none. Texts are read once, and not moved.
    """
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets are numbered in 16 bits")
    names = [key] if key else []
    kept = narrow(texts, *names, "text")
    kind = "".join(f"`{n}` {kept.schema[n].dataType.simpleString()}, " for n in names)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, counts, n_words = features(octets(batch, "text"), gram, buckets)
        ends = np.concatenate(([0], np.cumsum(2 * counts))).astype(np.int64)
        packed = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(found.astype("<u2"))])
        return pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.array(n_words, pa.int64()), packed.cast(pa.binary())],
            [*names, "n_words", "buckets"])

    return map_text(kept, work, f"{kind}n_words long, buckets binary")


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features fall into each bucket, over all rows of ``featured``.

    A task counts its rows into one array; the driver gets one number a bucket.
    """
    ship_package(rows.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column("buckets"):
                total += np.bincount(np.frombuffer(value.as_buffer(), "<u2"), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in (rows.select("buckets").mapInArrow(count, "bucket long, n long")
              .groupBy("bucket").agg(F.sum("n").alias("n")).collect()):
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray, scale: int = GAIN_SCALE) -> np.ndarray:
    """What a feature of each bucket adds: its smoothed log ratio, target over source, floored."""
    n, all_source, all_target = len(source), int(source.sum()), int(target.sum())
    return np.array([
        math.floor(scale * math.log((float(t + 1) * (all_source + n)) / (float(s + 1) * (all_target + n))))
        for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weighed(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """``n_features`` and ``weight``, the sum of gains, in place of the features of ``featured``."""
    ship_package(rows.sparkSession)
    everywhere = rows.sparkSession.sparkContext.broadcast(gain)  # one number a bucket
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "buckets")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = everywhere.value
        for batch in batches:
            held = [np.frombuffer(v.as_buffer(), "<u2") for v in batch.column("buckets")]
            counts = np.array([len(x) for x in held], np.int64)
            sums = segment_sums(gain[np.concatenate(held)], np.concatenate(([0], np.cumsum(counts))))
            names = [n for n in batch.schema.names if n != "buckets"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(counts), pa.array(sums)],
                [*names, "n_features", "weight"])

    return rows.mapInArrow(weigh, f"{schema}, n_features long, weight long")


# --- drawing ----------------------------------------------------------------

def noise(key: str = "doc_id", seed: int = SEED, scale: int = GAIN_SCALE) -> Column:
    """A whole number with the Gumbel distribution, settled by the key alone; a null key is empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-scale * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(scored: DataFrame, drawn: int) -> DataFrame:
    """``rank`` of the ``drawn`` highest scores, ties to the smaller doc_id, null for all others.

    Rows are dealt out by ranges of score and id and numbered within a range, then by the counts
    of the ranges before: one row per range goes through a window by itself. Rows that are alike in
    both are told apart by a number, so they may fill several ranges.
    """
    numbered = scored.withColumn("_row", F.monotonically_increasing_id())
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_row")]
    dealt = materialize(numbered.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    before = dealt.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = (F.row_number().over(Window.partitionBy("_range").orderBy(*order)) + F.col("_before")).cast("long")
    return dealt.join(before, "_range").withColumn("rank", F.when(place <= drawn, place)).drop(
        "_range", "_before", "_row")


def resample(documents: DataFrame, target: DataFrame, share_pct: int = SHARE_PCT, min_words: int = MIN_WORDS,
             gram: int = GRAM, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Every document's features, weight and score, and the rank of those drawn.

    Features are all runs of 1 to ``gram`` words, hashed; the weight adds up how much likelier each
    is in ``target`` than here; the noise makes the highest scores a sample without replacement,
    drawn by weight. ``share_pct`` percent of the documents with ``min_words`` or more are drawn.
    Documents are those of ``documents`` whatever their texts repeat. Null and empty texts have no
    feature, weigh 0, and are not drawn. Rows repeated with a doc_id have one score and stay as many
    rows; null doc_ids share one and come last among ties. Empty tables count as no features.
    Other columns are not read.
    """
    held = materialize(featured(documents, gram, buckets), "features")
    gain = gains(bucket_counts(held, buckets), bucket_counts(featured(target, gram, buckets, None), buckets))
    scored = materialize(
        weighed(held, gain).withColumn("score", F.col("weight") + noise(seed=seed)), "scores")
    eligible = scored.filter(F.col("n_words") >= min_words)
    drawn = share_pct * eligible.count() // 100
    others = scored.filter(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked(eligible, drawn).unionByName(others)


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def _grams_sql() -> str:
    """All runs of 1 to 3 words, from positions that hold as many."""
    return " UNION ALL ".join(
        f"SELECT source, id, array_to_string(w[i:i + {n - 1}], ' ') AS gram FROM ("
        f"SELECT source, id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM words WHERE len(w) >= {n})"
        for n in range(1, GRAM + 1))


RESAMPLING_SQL = f"""
WITH words AS MATERIALIZED (
    SELECT source, id, doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM (SELECT true AS source, row_number() OVER () AS id, doc_id, text FROM documents UNION ALL
          SELECT false, row_number() OVER (), NULL, text FROM benchmark)),
  grams AS MATERIALIZED ({_grams_sql()}),
  steps AS (
    SELECT list(list_reduce(range(8), lambda c, k: xor(c >> 1, (c & 1) * {_POLYNOMIAL}), v) ORDER BY v) AS t
    FROM range(256) r(v)),
  octets AS (
    SELECT gram, list_transform(range(0, octet_length(encode(gram))),
      lambda i: ('0x' || hex(encode(gram))[2 * i + 1:2 * i + 2])::BIGINT) AS bytes
    FROM (SELECT DISTINCT gram FROM grams)),
  crcs AS MATERIALIZED (
    SELECT gram, xor(list_reduce(bytes, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295),
      4294967295) % {BUCKETS} AS bucket FROM octets, steps),
  found AS MATERIALIZED (SELECT source, id, bucket FROM grams JOIN crcs USING (gram)),
  counts AS (
    SELECT bucket, count(*) FILTER (source) AS s, count(*) FILTER (NOT source) AS t FROM found GROUP BY bucket),
  gain AS (
    SELECT bucket, floor({GAIN_SCALE} * ln(
      ((t + 1)::DOUBLE * ((SELECT count(*) FROM found WHERE source) + {BUCKETS}))
      / ((s + 1)::DOUBLE * ((SELECT count(*) FROM found WHERE NOT source) + {BUCKETS}))))::BIGINT AS gain
    FROM counts),
  sums AS (
    SELECT id, count(*) AS n_features, sum(gain)::BIGINT AS weight
    FROM found JOIN gain USING (bucket) WHERE source GROUP BY id),
  scores AS (
    SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
      coalesce(weight, 0)::BIGINT + floor(-{GAIN_SCALE} * ln(-ln((
        ('0x' || sha256('{SEED}:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
    FROM words LEFT JOIN sums USING (id) WHERE source),
  places AS (
    SELECT *, row_number() OVER (PARTITION BY n_words >= {MIN_WORDS} ORDER BY score DESC, doc_id) AS place FROM scores)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= {MIN_WORDS}
  AND place <= {SHARE_PCT} * (SELECT count(*) FROM scores WHERE n_words >= {MIN_WORDS}) // 100 THEN place END AS rank
FROM places
"""
