"""Tokens counted by section: whole texts are encoded once, token spans meet section spans."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marquee.llm.common import load, map_text, narrow
from marquee.llm.pieces import Encoder, encoder

RULES = ("first", "largest", "shared")


@lru_cache(maxsize=2)
def _widths(held: Encoder) -> np.ndarray:
    """How many bytes of text each id stands for; the vocabulary writes a byte as one letter."""
    vocabulary = held.tokenizer.get_vocab(with_added_tokens=True)
    widths = np.zeros(max(vocabulary.values()) + 1, np.int64)
    added = held.tokenizer.get_added_tokens_decoder()
    for piece, number in vocabulary.items():
        widths[number] = len(piece.encode()) if number in added else len(piece)
    return widths


def token_spans(texts: list[str], held: Encoder) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every token in characters of all texts joined; and characters per text.

    A token that holds part of a character's bytes spans that character.
    """
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    character = np.cumsum((raw & 0xC0) != 0x80) - 1
    ids = np.frombuffer(b"".join(held.encode(texts)), held.dtype)
    ends = np.cumsum(_widths(held)[ids])
    starts = ends - _widths(held)[ids]
    assert (ends[-1] if len(ends) else 0) == len(raw), "tokens must tile the text"
    lengths = np.array([len(t) for t in texts], np.int64)
    return character[starts], character[ends - 1] + 1, lengths


def allocate(starts: np.ndarray, ends: np.ndarray, edges: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section, and how many of a section's tokens reach beyond it.

    Sections are the spans between consecutive ``edges``. A token within one section counts
    there. One that crosses an edge counts, by rule ``first``, where its first character is;
    by ``largest``, in the section that has most of its characters, the earlier one of equals;
    by ``shared``, in each by the share of its characters.
    """
    sections = len(edges) - 1
    first = np.searchsorted(edges, starts, "right") - 1
    last = np.searchsorted(edges, ends - 1, "right") - 1
    inside = first == last
    counts = np.bincount(first[inside], minlength=sections).astype(np.float64)
    crossing = np.zeros(sections, np.int64)
    for token in np.flatnonzero(~inside):
        own = np.arange(first[token], last[token] + 1)
        share = np.minimum(ends[token], edges[own + 1]) - np.maximum(starts[token], edges[own])
        crossing[own[share > 0]] += 1
        if rule == "shared":
            counts[own] += share / share.sum()
        else:
            counts[own[0 if rule == "first" else int(share.argmax())]] += 1
    return counts, crossing


def count_by_section(documents: DataFrame, rule: str = "largest", separator: str = "\n",
                     tokenizer: str | None = None) -> DataFrame:
    """One row per section of each text: its number, span in characters and tokens.

    A section ends after ``separator`` or with the text, so sections tile the text; a text that
    ends in the separator has no empty section after it. ``n_tokens`` follows ``rule`` (see
    ``allocate``) and adds up to the text's tokens; ``n_crossing`` counts those that also
    reach into another section. A null or empty text has one empty section. Equal rows give
    equal rows, an empty table an empty one. Texts are encoded whole and alone: no shuffle.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {', '.join(RULES)}")
    source = narrow(documents, "doc_id", "text")
    tokens = T.DoubleType() if rule == "shared" else T.LongType()
    schema = T.StructType([source.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in (
        "section", "begins", "ends")], T.StructField("n_tokens", tokens), T.StructField("n_crossing", T.LongType())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        starts, ends, lengths = token_spans(texts, encoder(tokenizer))
        edges, owners, numbers = [], [], []
        for row, text in enumerate(texts):
            sizes = [len(p) + len(separator) for p in text.split(separator)]
            sizes[-1] -= len(separator)
            if len(sizes) > 1 and not sizes[-1]:
                sizes.pop()
            owners += [row] * len(sizes)
            numbers += range(len(sizes))
            edges += sizes
        sizes = np.array(edges, np.int64)
        # empty texts have no characters; searchsorted on the right passes their empty sections
        edges = np.concatenate(([0], np.cumsum(sizes)))
        counts, crossing = allocate(starts, ends, edges, rule)
        base = np.repeat(np.cumsum(lengths) - lengths, np.bincount(owners, minlength=len(texts)))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(owners, pa.int64())), pa.array(numbers, pa.int64()),
             pa.array(edges[:-1] - base), pa.array(edges[1:] - base),
             pa.array(counts if rule == "shared" else counts.astype(np.int64)), pa.array(crossing)],
            schema.names)

    return map_text(source, work, schema)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_section(load(spark, sf_dir, "documents"))
