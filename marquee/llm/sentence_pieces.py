"""SentencePiece ids and decoded texts from a table of distinct marked words."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import load, map_text, narrow

MODEL = "piece_bpe_32k.model"
MARKER = "▁"
REMEMBERED = 400_000

# A marked word: the spaces before it, at least one, and what follows up to the next space.
_WORDS = re.compile(r" +[^ ]*")
_models: dict[str, Pieces] = {}


class Pieces:
    """A model, and the words of its texts segmented lately.

    The library writes a space as a marker and puts one before the text. If no piece has a
    marker after another character, no merge joins a word with the marker of the next, so a
    word's ids do not depend on its neighbours. A model that breaks this is not taken apart.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        self.separable = not any(MARKER in p.lstrip(MARKER) for p in pieces) and self.plain()
        ends = [self.model.bos_id()], [self.model.eos_id()]
        self.begin, self.end = (np.array([i for i in e if i >= 0], "<u4").tobytes() for e in ends)
        self.known: dict[str, tuple[bytes, bytes]] = {}

    def plain(self) -> bool:
        """Whether texts are taken as they are, with all spaces and one marker before them."""
        sample = " a  b ﬁ "
        return (self.model.decode(self.model.encode(sample)) == sample
                and self.model.piece_to_id(MARKER) != self.model.unk_id())

    def remember(self, words: set[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = list(words.difference(self.known))
        for begin in range(0, len(new), 4096):
            some = new[begin:begin + 4096]
            found = self.model.encode([w[1:] for w in some], num_threads=1)
            # of a marker alone the library is given nothing, so it is looked up
            found = [ids if len(w) > 1 else [self.model.piece_to_id(MARKER)] for w, ids in zip(some, found)]
            texts = self.model.decode([ids if len(w) > 1 else [] for w, ids in zip(some, found)],
                                      num_threads=1)
            self.known.update((w, (np.array(ids, "<u4").tobytes(), b" " + t.encode()))
                              for w, ids, t in zip(some, found, texts))

    def whole(self, text: str) -> tuple[bytes, bytes]:
        ids = self.model.encode(text)
        return np.array(ids, "<u4").tobytes(), self.model.decode(ids).encode()

    def process(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """The ids of each text as 32-bit numbers, begin and end included, and its decoding."""
        cut = [_WORDS.findall(" " + t.replace(MARKER, " ")) if t and self.separable else None for t in texts]
        self.remember(set().union(*(c for c in cut if c)))
        out = []
        for text, words in zip(texts, cut):
            if words:
                parts = [self.known[w] for w in words]
                ids = b"".join([p[0] for p in parts])
                decoded = b"".join([p[1] for p in parts])[1:]
            else:
                ids, decoded = self.whole(text)
            out.append((self.begin + ids + self.end, decoded))
        return out


def pieces(path: str | None = None) -> Pieces:
    """One model per worker and file."""
    path = path or public_tokenizers.path(MODEL)
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def encode(documents: DataFrame, model: str | None = None, carry: bool = False) -> DataFrame:
    """``ids`` and ``decoded`` text of each document; with ``carry`` also its other columns as ``row``.

    Ids are those of the library for the whole text, with begin and end ids. A null or empty
    text has these two only and decodes to an empty one. Each distinct word of a worker's
    texts is segmented once, and ids are joined back in word order, so no shuffle is needed;
    a text of any length is cut into words, and repeated rows give equal rows.
    """
    others = [f"`{c}`" for c in documents.columns if c != "text"]
    source = documents.select("doc_id", "text", *[F.struct(*others).alias("row")] * carry)
    names = ["doc_id", *["row"] * carry]
    schema = T.StructType(
        [source.schema[n] for n in names] + [T.StructField("ids", T.ArrayType(T.IntegerType())),
                                             T.StructField("decoded", T.StringType())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        done = pieces(model).process([t or "" for t in batch.column("text").to_pylist()])
        ids = pa.array(np.frombuffer(b"".join(d[0] for d in done), "<u4").astype(np.int32))
        ends = np.cumsum([0, *[len(d[0]) // 4 for d in done]])
        return pa.RecordBatch.from_arrays(
            [batch.column(n) for n in names]
            + [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids),
               pa.array([d[1].decode() for d in done])], [*names, "ids", "decoded"])

    return map_text(source, work, schema)


def digests(documents: DataFrame, model: str | None = None) -> DataFrame:
    """Count and checksums of what ``encode`` gives, without moving ids out of the worker."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        done = pieces(model).process([t or "" for t in batch.column("text").to_pylist()])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(ids) // 4 for ids, _ in done], pa.int64()),
             pa.array([hashlib.sha256(ids).hexdigest() for ids, _ in done]),
             pa.array([hashlib.sha256(text).hexdigest() for _, text in done])],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    source = narrow(documents, "doc_id", "text")
    schema = T.StructType([
        source.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    return map_text(source, work, schema)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(load(spark, sf_dir, "documents"))
