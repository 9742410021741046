"""Benchmark items found in training texts: BM25 by block-max WAND, then overlap of words."""

from __future__ import annotations

from collections import Counter, deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import keep_rows, load, map_text, narrow, numbered, octets, ship_package
from marquee.sources.tables import materialize

SHINGLE = 5
OVERLAP_PCT = 80
PART_PCT = 50
K1, B = 1.2, 0.75
# Items, and words of items, indexed at once. A larger benchmark is searched for in several passes
# over the texts, so what a worker holds stays bounded; the index of one pass takes a few MB.
PASS_ITEMS, PASS_WORDS = 1024, 200_000
BLOCK_ITEMS = 16
# An item is looked for in windows of twice its words and this much more, to leave room for words
# put in. Passages are cut so that each window of each item lies within one.
ROOM = 1.25

# Letters and digits of ASCII in lower case and all bytes of other characters make up words.
_FOLD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def shingles(tokens: list[bytes], size: int = SHINGLE) -> set[bytes]:
    """Runs of ``size`` words; of fewer words, all of them as one run; none of no word."""
    size = min(size, len(tokens))
    return {b" ".join(tokens[i:i + size]) for i in range(len(tokens) - size + 1)} if tokens else set()


@dataclass
class Item:
    item_id: int | None
    question: list[bytes]
    answer: list[bytes]

    def __post_init__(self):
        self.q, self.a = shingles(self.question), shingles(self.answer)

    def missing_words(self) -> int:
        """At most so many words can be absent from a passage that has enough of the shingles."""
        absent = (100 - OVERLAP_PCT) * (len(self.q) + len(self.a)) // 100
        short = any(0 < len(p) < SHINGLE for p in (self.question, self.answer))
        # shingles that occur twice in an item count once, but uncover words in two places
        twice = len(self.question) + len(self.answer) - 2 * (SHINGLE - 1) - len(self.q) - len(self.a)
        return absent * (SHINGLE if short else 1) * (1 + max(0, twice))

    def span(self) -> int:
        """The words of a window that is searched for the item; of other items none counts."""
        return 2 * stride_of(len(self.question) + len(self.answer))

    def found_in(self, passage: list[bytes]) -> tuple[int, int] | None:
        """Shingles of question and answer in the best window of the passage, if they are enough.

        Windows begin at every word. Only those that end with a shingle of the item can be
        better than the one before them.
        """
        places = []
        for part, (words_of, grams) in enumerate(((self.question, self.q), (self.answer, self.a))):
            size = min(SHINGLE, len(words_of))
            for i in range(len(passage) - size + 1 if grams else 0):
                gram = b" ".join(passage[i:i + size])
                if gram in grams:
                    places.append((i + size, i, part, gram))
        if not self._enough(*(len({g for _, _, p, g in places if p == part}) for part in (0, 1))):
            return None
        span, best = self.span(), None
        held, counts = (deque(), deque()), (Counter(), Counter())
        for end, begin, part, gram in sorted(places):
            held[part].append((begin, gram))
            counts[part][gram] += 1
            for own, seen in zip(held, counts):
                while own and own[0][0] < end - span:
                    gone = own.popleft()[1]
                    seen[gone] -= 1
                    if not seen[gone]:
                        del seen[gone]
            got = (len(counts[0]), len(counts[1]))
            if self._enough(*got) and (best is None or (sum(got), got) > (sum(best), best)):
                best = got
        return best

    def _enough(self, q: int, a: int) -> bool:
        return (100 * (q + a) >= OVERLAP_PCT * (len(self.q) + len(self.a))
                and 100 * q >= PART_PCT * len(self.q) and 100 * a >= PART_PCT * len(self.a))


def stride_of(length: int) -> int:
    """The words between passages for items of at most ``length`` words."""
    return max(1, int(length * ROOM + 1))


class Index:
    """Postings of some items in blocks, with the largest weight of each term per block.

    A weight is a term's part of the BM25 score over the score the item must reach. That is
    what is left of the item's score for its own words when the heaviest that a passage may
    lack are taken away, so no passage with the overlap asked for scores less than 1.
    """

    def __init__(self, items: list[Item], frequency: dict[bytes, int], total: int, mean: float):
        self.items = items
        self.terms: dict[bytes, int] = {}
        postings: list[tuple[int, int, float]] = []
        for number, item in enumerate(items):
            tokens = item.question + item.answer
            level = K1 * (1 - B + B * len(tokens) / mean)
            weights = {
                t: np.log1p((total - frequency[t] + 0.5) / (frequency[t] + 0.5)) * n * (K1 + 1) / (n + level)
                for t, n in Counter(tokens).items()}
            heaviest = sorted(weights.values(), reverse=True)[: item.missing_words()]
            least = max(sum(weights.values()) - sum(heaviest), 1e-9)
            for term, weight in weights.items():
                postings.append((self.terms.setdefault(term, len(self.terms)), number, weight / least))
        blocks = -(-len(items) // BLOCK_ITEMS)
        self.most = np.zeros((len(self.terms), blocks), np.float32)
        self.local = np.zeros((blocks, len(self.terms)), np.int32)
        held: list[list[np.ndarray]] = [[np.zeros(BLOCK_ITEMS, np.float32)] for _ in range(blocks)]
        for term, number, weight in postings:
            block, place = divmod(number, BLOCK_ITEMS)
            self.most[term, block] = max(self.most[term, block], weight)
            if not self.local[block, term]:
                self.local[block, term] = len(held[block])
                held[block].append(np.zeros(BLOCK_ITEMS, np.float32))
            held[block][self.local[block, term]][place] = weight
        self.weights = [np.array(h) for h in held]
        self.best = self.most.max(axis=1, initial=0)

    def search(self, texts: list[list[bytes]], stride: int) -> Iterator[tuple[int, int, int]]:
        """(text, passage, item) of every passage that scores enough for an item.

        Passages of three strides begin at every stride, so each holds all windows of two
        strides that begin before the next passage. A passage is left as soon as the
        largest weights of its terms add up to too little, then block by block; only in blocks
        that can reach the score are items scored.
        """
        counts = np.array([len(t) for t in texts], np.int64)
        ids = np.fromiter((self.terms.get(w, -1) for t in texts for w in t), np.int64, counts.sum())
        text = np.repeat(np.arange(len(texts)), counts)
        place = np.arange(len(ids)) - np.repeat(np.cumsum(counts) - counts, counts)
        known = ids >= 0
        ids, text, passage = ids[known], text[known], place[known] // stride
        back = [passage >= n for n in range(3)]
        widest = int(passage.max(initial=0)) + 1
        keys = np.concatenate([(text * widest + passage - n)[b] for n, b in enumerate(back)])
        if not len(keys):
            return
        pairs = np.unique(keys * len(self.terms) + np.concatenate([ids[b] for b in back]))
        owner, term = np.divmod(pairs, len(self.terms))
        enough = np.float32(1 - 1e-4)

        def starts(owner: np.ndarray) -> np.ndarray:
            return np.flatnonzero(np.diff(owner, prepend=-1))

        begin = starts(owner)
        reach = np.add.reduceat(self.best[term], begin) >= enough
        stay = np.repeat(reach, np.diff(begin, append=len(owner)))
        owner, term = owner[stay], term[stay]
        if not len(owner):
            return
        for block in range(self.most.shape[1]):
            begin = starts(owner)
            reach = np.add.reduceat(self.most[term, block], begin) >= enough
            if not reach.any():
                continue
            stay = np.repeat(reach, np.diff(begin, append=len(owner)))
            mine, terms = owner[stay], term[stay]
            begin = starts(mine)
            scores = np.add.reduceat(self.weights[block][self.local[block, terms]], begin, axis=0)
            for row, place in np.argwhere(scores >= enough):
                where = int(mine[begin[row]])
                yield where // widest, where % widest, block * BLOCK_ITEMS + int(place)

    def leaks(self, texts: list[bytes], stride: int) -> dict[tuple[int, int], tuple[int, int]]:
        """Shingles found of question and answer, by text and item, in the best passage."""
        tokens = [words(t) for t in texts]
        found: dict[tuple[int, int], tuple[int, int]] = {}
        for text, passage, number in self.search(tokens, stride):
            hits = self.items[number].found_in(tokens[text][passage * stride: (passage + 3) * stride])
            if hits:
                before = found.get((text, number), (-1, -1))
                found[text, number] = max(before, hits, key=lambda h: (sum(h), h))
        return found


def indexes(items: DataFrame) -> tuple[int, int, Callable[[int], Index | None]]:
    """The stride of passages, the number of passes, and what builds the index of a pass.

    Term statistics are counted by Spark over all items. The index of a pass is built when it is
    asked for, from the items of that pass and the frequencies of their words.
    """
    spark = items.sparkSession
    ship_package(spark)
    distinct = items.select(
        "item_id", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("question", "answer")]
    ).distinct()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [[words(t) for t in octets(batch, c)] for c in ("question", "answer")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), *[pa.array(p, pa.list_(pa.binary())) for p in parts]],
                ["item_id", "question", "answer"])

    schema = T.StructType([
        distinct.schema["item_id"], *[T.StructField(c, T.ArrayType(T.BinaryType())) for c in ("question", "answer")]])
    counted = distinct.mapInArrow(cut, schema).withColumn("words", F.concat("question", "answer"))
    counted = counted.filter(F.size("words") > 0).withColumn("digest", F.xxhash64("item_id", "words"))
    total, longest, length = counted.agg(
        F.count("*"), F.coalesce(F.max(F.size("words")), F.lit(0)), F.sum(F.size("words"))).first()
    passes = max(1, -(-total // PASS_ITEMS), -(-(length or 0) // PASS_WORDS))
    counted = materialize(counted.withColumn("pass", F.pmod("digest", F.lit(passes))), "items")
    terms = counted.select("pass", F.explode(F.array_distinct("words")).alias("term"))
    frequency = materialize(terms.groupBy("term").agg(F.count("*").alias("n")), "frequency")

    def build(number: int) -> Index | None:
        chosen = counted.filter(F.col("pass") == number).orderBy("digest").toArrow().to_pylist()
        if not chosen:
            return None
        own = frequency.join(terms.filter(F.col("pass") == number).select("term").distinct(), "term").collect()
        held = [Item(r["item_id"], r["question"], r["answer"]) for r in chosen]
        return Index(held, {bytes(r.term): r.n for r in own}, total, length / total)

    return stride_of(longest), passes, build


def leaked(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs of documents and items of which they have question and answer.

    ``items`` has item_id, question and answer. A pair is kept if some window of the document,
    of twice the item's words and a quarter more, has at least 80 % of the five-word shingles of
    both together, and half of each. Case and punctuation do not count. Rows: doc_id, item_id,
    shingles found and asked for of question (q_found, q_shingles) and answer. Items without words are never found, and repeated items
    count once. Null or empty texts have nothing, repeated rows are repeated.
    """
    return _leaked(documents, items, *indexes(items))


def _leaked(documents: DataFrame, items: DataFrame, stride: int, passes: int,
            build: Callable[[int], Index | None]) -> DataFrame:
    """Of several passes, each is stored and its index given up before the next is built."""
    source = narrow(documents, "doc_id", "text")
    kind = items.schema["item_id"]
    names = ["q_found", "q_shingles", "a_found", "a_shingles"]
    schema = T.StructType([source.schema["doc_id"], kind, *[T.StructField(n, T.LongType()) for n in names]])
    batch_type = pa.int64() if isinstance(kind.dataType, T.LongType) else None
    out = None
    for number in range(passes):
        index = build(number)
        if index is None:
            continue
        everywhere = documents.sparkSession.sparkContext.broadcast(index)
        del index

        def work(batch: pa.RecordBatch, everywhere=everywhere) -> pa.RecordBatch:
            index = everywhere.value
            pairs = index.leaks(octets(batch, "text"), stride)
            rows = [(index.items[n], *hits) for (_, n), hits in pairs.items()]
            ids = pa.array([r[0].item_id for r in rows], batch_type)
            numbers = [[r[1] for r in rows], [len(r[0].q) for r in rows],
                       [r[2] for r in rows], [len(r[0].a) for r in rows]]
            texts = pa.array([t for t, _ in pairs], pa.int64())
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(texts), ids, *[pa.array(n, pa.int64()) for n in numbers]],
                schema.names)

        part = map_text(source, work, schema)
        if passes > 1:
            part = materialize(part, "leaks")
            everywhere.destroy()
        out = part if out is None else out.union(part)
    return out if out is not None else documents.sparkSession.createDataFrame([], schema)


def keep_clean(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The documents, columns unchanged, in which no item is found.

    After several passes, what was found in each is known by the digest of the text. Null and empty
    texts stay, and so do rows that repeat each other if their text does. Without items everything
    stays; an empty table gives an empty one.
    """
    stride, passes, build = indexes(items)
    if passes > 1:
        rows, names = numbered(documents)
        digest = F.sha2(F.col("text").cast("binary"), 256)
        bad = _leaked(documents.select(digest.alias("doc_id"), "text"), items, stride, passes, build)
        bad = bad.select(F.col("doc_id").alias("digest")).distinct()
        rows = rows.withColumn("digest", F.sha2(F.col(names["text"]).cast("binary"), 256))
        return rows.join(bad, "digest", "left_anti").select(*names.values()).toDF(*documents.columns)
    index = build(0)
    if index is None:
        return documents
    everywhere = documents.sparkSession.sparkContext.broadcast(index)

    def judge(texts: list[bytes]) -> np.ndarray:
        good = np.ones(len(texts), bool)
        good[[text for text, _ in everywhere.value.leaks(texts, stride)]] = False
        return good

    return keep_rows(documents, judge)


def halves(benchmark: DataFrame) -> DataFrame:
    """Items of a table with one text each: the first two thirds of the words are the question."""
    tokens = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = F.ceil(F.size("w") * 2 / 3).cast("int")
    return benchmark.select("item_id", tokens.alias("w")).select(
        "item_id", F.array_join(F.slice("w", F.lit(1), cut), " ").alias("question"),
        F.array_join(F.slice("w", cut + 1, F.size("w")), " ").alias("answer"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked(load(spark, sf_dir, "documents"), halves(load(spark, sf_dir, "benchmark")))


def _folded(text: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            "'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')")


# A window of an item's own span ends with each shingle met. Items of fewer than ten words are short
# of five in a part.
LEAK_SQL = f"""
WITH split AS (
    SELECT DISTINCT item_id, w[:c] AS q, w[c + 1:] AS a FROM (
      SELECT item_id, w, ceil(len(w) * 2 / 3)::BIGINT AS c FROM (
        SELECT item_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM benchmark))),
  parts AS (
    SELECT item_id, 'q' AS part, {_folded("array_to_string(q, ' ')")} AS w FROM split
    UNION ALL SELECT item_id, 'a', {_folded("array_to_string(a, ' ')")} FROM split),
  spans AS (
    SELECT item_id, 2 * greatest(1, floor(sum(len(w)) * {ROOM} + 1))::BIGINT AS span FROM parts GROUP BY item_id),
  asked AS (
    SELECT DISTINCT item_id, part, least(len(w), {SHINGLE}) AS size,
      array_to_string(w[i:i + least(len(w), {SHINGLE}) - 1], ' ') AS gram
    FROM (SELECT *, unnest(range(1, len(w) - least(len(w), {SHINGLE}) + 2)) AS i FROM parts WHERE len(w) > 0)),
  totals AS (
    SELECT item_id, count(*) FILTER (part = 'q') AS q_shingles, count(*) FILTER (part = 'a') AS a_shingles
    FROM asked GROUP BY item_id),
  texts AS (SELECT doc_id, {_folded("text")} AS w FROM documents),
  grams AS (
    SELECT doc_id, i - 1 AS p, size, array_to_string(w[i:i + size - 1], ' ') AS gram
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
          FROM texts, (SELECT DISTINCT size FROM asked) WHERE len(w) >= size)),
  met AS (SELECT doc_id, p, g.size, item_id, part, gram FROM grams g JOIN asked USING (size, gram)),
  able AS (
    SELECT doc_id, item_id FROM met JOIN totals USING (item_id) GROUP BY doc_id, item_id, q_shingles, a_shingles
    HAVING 100 * count(DISTINCT (part, gram)) >= {OVERLAP_PCT} * (q_shingles + a_shingles)),
  near AS (SELECT met.* FROM met SEMI JOIN able USING (doc_id, item_id)),
  ends AS (SELECT DISTINCT doc_id, item_id, p + size AS e, span FROM near JOIN spans USING (item_id)),
  hits AS (
    SELECT doc_id, item_id, e, count(DISTINCT gram) FILTER (part = 'q') AS q_found,
      count(DISTINCT gram) FILTER (part = 'a') AS a_found
    FROM ends JOIN near USING (doc_id, item_id) WHERE p + size <= e AND p >= e - span GROUP BY doc_id, item_id, e)
SELECT doc_id, item_id, q_found, q_shingles, a_found, a_shingles FROM hits JOIN totals USING (item_id)
WHERE 100 * (q_found + a_found) >= {OVERLAP_PCT} * (q_shingles + a_shingles)
  AND 100 * q_found >= {PART_PCT} * q_shingles AND 100 * a_found >= {PART_PCT} * a_shingles
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY q_found + a_found DESC, q_found DESC) = 1
"""
