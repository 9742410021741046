"""Operators that look at one text at a time, against plain versions."""

import random
import subprocess
import sys
from pathlib import Path

import brute
import numpy as np
import pytest
from samples import odd_texts

from marquee.llm import pieces, quality, sentence_pieces, simhash, token_counts

QUALITY = ["doc_id", *quality.MEASURES, "base_failed", "kept"]
TOKENS = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
SECTIONS = ["doc_id", "section", "begins", "ends", "n_tokens", "n_crossing"]


def plain_quality(rows):
    found = [brute.quality(d, t, quality.GRAM_LIMITS, quality.LINE_LIMIT) for d, t in rows]
    return [tuple(f[c] for c in QUALITY) for f in found]


def test_quality(odd, given, same):
    same(quality.repetition(odd), plain_quality(odd_texts()), *QUALITY)
    same(quality.repetition(given[0]), plain_quality(given[1]), *QUALITY)


def test_quality_keeps_columns(odd, none):
    kept = quality.keep_good(odd)
    assert kept.schema.names == odd.schema.names
    want = [r for r in plain_quality(odd_texts()) if r[-1]]
    assert kept.count() == len(want) > 3
    assert quality.keep_good(none).count() == quality.repetition(none).count() == 0


def test_sentence_pieces(odd, given, none, same):
    same(sentence_pieces.digests(odd), brute.pieces(odd_texts()), *TOKENS)
    same(sentence_pieces.digests(given[0]), brute.pieces(given[1]), *TOKENS)
    assert sentence_pieces.encode(none).count() == 0


def test_sentence_pieces_ids(odd, same):
    model = brute.sp()
    want = [(d, [1, *model.encode(t or ""), 2], model.decode(model.encode(t or ""))) for d, t in odd_texts()]
    same(sentence_pieces.encode(odd, carry=True), want, "doc_id", "ids", "decoded")


def test_word_tables_follow_the_libraries():
    """Random texts of awkward characters, cut at words, give the whole texts' ids."""
    rng, parts = random.Random(0), ["a", "b", " ", " ", "\n", "\t", "%", "1", "é", "\xa0", "'s", "▁", "\x1f",
                                    "<|endoftext|>", "　", "<s>", "漢"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(3000)]
    held, bpe, model = pieces.encoder(), brute.bpe(), brute.sp()
    for text, ids in zip(texts, held.encode(texts)):
        assert np.frombuffer(ids, held.dtype).tolist() == bpe.encode(text, add_special_tokens=False).ids
    for text, (ids, decoded) in zip(texts, sentence_pieces.pieces().process(texts)):
        want = [1, *model.encode(text), 2]
        assert (np.frombuffer(ids, "<u4").tolist(), decoded.decode()) == (want, model.decode(want))


def test_word_tables_start_anew(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    monkeypatch.setattr(pieces, "PARTS", 3)
    held = pieces.Encoder(pieces.public_tokenizers.path(pieces.BYTE_BPE))
    texts = ["one two three four five", "five four three two one six"]
    once = held.encode(texts)
    assert held.encode(texts) == once and held.encode(texts[::-1]) == once[::-1]


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts(odd, given, rule):
    tokenizer = brute.bpe()
    rows = [*odd_texts(), *given[1]]
    both = odd.select("doc_id", "text").union(given[0].select("doc_id", "text"))
    got = [tuple(r) for r in token_counts.count_by_section(both, rule).select(SECTIONS).collect()]
    want = [s for d, t in rows for s in brute.sections(d, t, tokenizer, rule)]
    key = lambda r: [(x is not None, round(x, 6) if x is not None else 0) for x in r]
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[4:] for r in got], [r[4:] for r in want])


def test_token_counts_rules(none):
    starts, ends, edges = np.array([0, 2, 5]), np.array([2, 5, 6]), np.array([0, 3, 6])
    for rule, want in (("first", [2, 1]), ("largest", [1, 2]), ("shared", [1 + 1 / 3, 1 + 2 / 3])):
        counts, crossing = token_counts.allocate(starts, ends, edges, rule)
        assert np.allclose(counts, want) and crossing.tolist() == [1, 1]
    tie = token_counts.allocate(np.array([0]), np.array([4]), np.array([0, 2, 4]), "largest")[0]
    assert tie.tolist() == [1, 0]
    with pytest.raises(ValueError):
        token_counts.count_by_section(none, "no such rule")
    assert token_counts.count_by_section(none).count() == 0


def test_fingerprints_of_texts_taken_in_parts(monkeypatch):
    texts = [(t or "").encode() for _, t in odd_texts()]
    whole = [simhash.fingerprint(texts, n).tolist() for n in (1, 3, 5)]
    assert whole[1] == [brute.fingerprint(t) for _, t in odd_texts()]
    monkeypatch.setattr(simhash, "PART", 11)
    monkeypatch.setattr(simhash, "BLOCK", 4)
    assert [simhash.fingerprint(texts, n).tolist() for n in (1, 3, 5)] == whole


def test_a_very_long_text_takes_little_memory():
    """A fingerprint of 30 MB of words, in a process of its own."""
    code = """
import random, resource
from marquee.llm import simhash
words = ["".join(random.choices("abcdefgh", k=random.randint(2, 9))) for _ in range(9000)]
text = " ".join(random.choices(words, k=4_700_000)).encode()
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
simhash.fingerprint([text])
print(len(text), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True,
                         cwd=Path(simhash.__file__).parents[2])
    size, grown = map(int, out.stdout.split())
    assert size > 25e6 and grown < 500_000  # in KB
