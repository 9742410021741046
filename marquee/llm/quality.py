"""Quality rules from repetition: which characters lie in repeated n-grams and lines."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marquee.llm.common import keep_rows, load, map_text, narrow, octets, segment_sums

# The base rules.
MIN_WORDS = 10
MAX_REPEAT_WORDS_PCT = 20
BASE_GRAM = 5
SYMBOLS = b"#*$%&|<>"

# The method's own rules: the most characters, in percent of those in words, that may lie in
# n-grams found twice or more; and the most that may lie in lines equal to an earlier one.
# A longer n-gram covers less of a text, so its limit is lower.
GRAM_LIMITS = {5: 25, 8: 22, 12: 20}
LINE_LIMIT = 30

MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars",
    *[f"gram{n}_chars" for n in GRAM_LIMITS],
]
BASE = np.uint64(0x9E3779B97F4A7C15)
DOCUMENT = np.uint64(0xC2B2AE3D27D4EB4F)


def covered(codes: np.ndarray, document: np.ndarray, n: int, rolled: np.ndarray) -> np.ndarray:
    """Which words lie in an ``n``-gram that its document has twice or more.

    ``rolled`` has the hash of the ``n`` words from each position on.
    """
    inside = np.zeros(len(codes) + 1, dtype=np.int32)
    if len(rolled):
        whole = np.flatnonzero(document[: len(rolled)] == document[n - 1:])
        keys = rolled[whole] ^ (document[whole].astype(np.uint64) + np.uint64(1)) * DOCUMENT
        order = np.argsort(keys)
        same = keys[order[1:]] == keys[order[:-1]]
        twice = np.zeros(len(keys), dtype=bool)
        twice[order[1:]] = same
        twice[order[:-1]] |= same
        starts = whole[twice]
        inside[starts] += 1
        np.subtract.at(inside, starts + n, 1)
    return np.cumsum(inside[:-1]) > 0


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The measures of each text, all texts of a slice at once.

    Words are maximal runs without ASCII white space. N-gram hashes are polynomials in 64-bit
    word hashes, rolled from one length to the next.
    """
    words = [t.split() for t in texts]
    counts = np.array([len(w) for w in words], dtype=np.int64)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    document = np.repeat(np.arange(len(texts)), counts)
    codes = np.fromiter((hash(w) for ws in words for w in ws), np.int64, bounds[-1]).view(np.uint64)
    sizes = np.fromiter((len(w.decode()) for ws in words for w in ws), np.int64, bounds[-1])
    del words

    flat = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    repeated, repeated_chars = [], []
    for text in texts:
        lines = [x for x in text.split(b"\n") if x.strip()]
        distinct = set(lines)
        repeated.append(len(lines) - len(distinct))
        chars = 0
        if repeated[-1]:
            later = sum(len(b"".join(x.split()).decode()) for x in lines)
            chars = later - sum(len(b"".join(x.split()).decode()) for x in distinct)
        repeated_chars.append(chars)

    out = {
        "n_words": counts, "word_chars": segment_sums(sizes, bounds),
        "n_symbols": segment_sums(symbol[flat], ends),
        "n_dup_lines": np.array(repeated, np.int64),
        "dup_line_chars": np.array(repeated_chars, np.int64),
    }
    rolled = codes
    for n in range(2, max(BASE_GRAM, *GRAM_LIMITS) + 1):
        rolled = rolled[: max(len(codes) - n + 1, 0)] * BASE + codes[n - 1:]
        if n == BASE_GRAM or n in GRAM_LIMITS:
            inside = covered(codes, document, n, rolled)
            if n == BASE_GRAM:
                out["n_repeat_words"] = segment_sums(inside, bounds)
            if n in GRAM_LIMITS:
                out[f"gram{n}_chars"] = segment_sums(np.where(inside, sizes, 0), bounds)
    return out


def verdicts(found: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Which texts the base rules fail, and which all rules keep."""
    failed = (found["n_words"] < MIN_WORDS) | (
        100 * found["n_repeat_words"] > MAX_REPEAT_WORDS_PCT * found["n_words"])
    repetitive = 100 * found["dup_line_chars"] > LINE_LIMIT * found["word_chars"]
    for n, limit in GRAM_LIMITS.items():
        repetitive |= 100 * found[f"gram{n}_chars"] > limit * found["word_chars"]
    return failed, ~failed & ~repetitive


def repetition(documents: DataFrame) -> DataFrame:
    """Measures and verdicts, one row per document.

    A text without words (null, empty, blank) has 0 everywhere and fails the base rules. Equal
    rows give equal rows; an empty table gives an empty one. Documents are measured alone, so
    no shuffle is needed and a copied text costs no more than any other.
    """
    source = narrow(documents, "doc_id", "text")
    rules = ["base_failed", "kept"]
    schema = T.StructType(
        [source.schema["doc_id"], *(T.StructField(m, T.LongType()) for m in MEASURES),
         *(T.StructField(r, T.BooleanType()) for r in rules)])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = measure(octets(batch, "text"))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(found[m], pa.int64()) for m in MEASURES),
             *map(pa.array, verdicts(found))], ["doc_id", *MEASURES, *rules])

    return map_text(source, work, schema)


def keep_good(documents: DataFrame) -> DataFrame:
    """The documents, all columns unchanged, that the rules keep.

    Null, empty and blank texts go. Rows that repeat each other stay or go together; null ids are
    ids like any other. An empty table gives an empty one.
    """
    return keep_rows(documents, lambda texts: verdicts(measure(texts))[1])


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition(load(spark, sf_dir, "documents"))


def _grams(n: int) -> str:
    """Of each document: the words and characters inside repeated n-grams."""
    return f"""
  grams{n} AS (
    SELECT doc_id, i, array_to_string(w[i:i + {n - 1}], ' ') AS gram
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM words WHERE len(w) >= {n})),
  starts{n} AS (
    SELECT doc_id, i FROM grams{n}
    QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
  inside{n} AS (
    SELECT doc_id, count(*) AS n_in, sum(length(word)) AS chars
    FROM (SELECT DISTINCT s.doc_id, s.i + o.o AS p FROM starts{n} s, range({n}) o(o)) x
    JOIN (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words) y
      USING (doc_id, p)
    GROUP BY doc_id)"""


QUALITY_SQL = f"""
WITH words AS (
    SELECT doc_id, coalesce(text, '') AS text,
      regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
  lines AS (
    SELECT doc_id, line, count(*) AS n,
      length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g')) AS chars
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id, line),
  repeated AS (
    SELECT doc_id, sum(n - 1) AS n_dup, sum((n - 1) * chars) AS chars FROM lines GROUP BY doc_id),
{",".join(_grams(n) for n in GRAM_LIMITS)},
  found AS (
    SELECT words.doc_id, len(w)::BIGINT AS n_words,
      length(array_to_string(w, ''))::BIGINT AS word_chars,
      length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
      coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
      coalesce(inside5.n_in, 0)::BIGINT AS n_repeat_words,
      coalesce(repeated.chars, 0)::BIGINT AS dup_line_chars,
      {", ".join(f"coalesce(inside{n}.chars, 0)::BIGINT AS gram{n}_chars" for n in GRAM_LIMITS)}
    FROM words LEFT JOIN repeated USING (doc_id)
    {" ".join(f"LEFT JOIN inside{n} USING (doc_id)" for n in GRAM_LIMITS)})
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_WORDS_PCT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_WORDS_PCT} * n_words
    OR 100 * dup_line_chars > {LINE_LIMIT} * word_chars
    {" ".join(f"OR 100 * gram{n}_chars > {limit} * word_chars" for n, limit in GRAM_LIMITS.items())}) AS kept
FROM found
"""
