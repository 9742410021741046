"""Plain versions of the operators, one text after the other, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
import xxhash
from tokenizers import Tokenizer

WORD = re.compile("[^\x20\x09-\x0d]+")


def bpe():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def sp():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def fingerprint(text: str | None) -> int:
    words = WORD.findall(lower(text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints: list[int], distance: int = 2) -> list[int]:
    """For each fingerprint, the number of its component."""
    label = list(range(len(prints)))
    values = np.array(prints, np.uint64)
    near = [np.flatnonzero(np.bitwise_count(values ^ v) <= distance) for v in values]
    for start in range(len(prints)):
        if label[start] == start:
            front = [start]
            while front:
                for k in near[front.pop()]:
                    if label[k] > start:
                        label[k] = start
                        front.append(k)
    return label


def components(rows: list[tuple]) -> list[tuple]:
    """(doc_id, fingerprint, component_id) of (doc_id, text) rows."""
    prints = [fingerprint(t) for _, t in rows]
    label = linked(prints)
    least: dict[int, int | None] = {}
    for (doc_id, _), own in zip(rows, label):
        known = [x for x in (least.get(own), doc_id) if x is not None]
        least[own] = min(known, default=None)
    return [(d, f"{p:016x}", least[own]) for (d, _), p, own in zip(rows, prints, label)]


def tokens(rows: list[tuple]) -> list[tuple]:
    tokenizer, place, out = bpe(), 0, []
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((doc_id, place, len(ids), zlib.crc32(ids.tobytes())))
        place += len(ids)
    return out


def warc(rows: list[tuple]) -> list[tuple]:
    keeper: dict[bytes, int] = {}
    for page_id, html in rows:
        payload = (html or "").encode()
        if len(payload) >= 1000 and page_id is not None:
            keeper[payload] = max(keeper.get(payload, page_id), page_id)
    out = []
    for page_id, html in rows:
        payload = (html or "").encode()
        refers = keeper.get(payload)
        refers = None if refers == page_id else refers
        out.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(),
                    "response" if refers is None else "revisit", refers))
    return out


def removed(texts: list[str | None], length: int = 400) -> list[tuple[list[tuple[int, int]], bytes]]:
    """Spans that go and bytes that stay, of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i:i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for text in raw:
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if seen[text[i:i + length]] > 1:
                gone[i:i + length] = b"\x01" * length
        spans = [m.span() for m in re.finditer(b"\x01+", bytes(gone))]
        out.append((spans, bytes(c for c, g in zip(text, gone) if not g)))
    return out


def repeats(rows: list[tuple], length: int = 400) -> list[tuple]:
    out = []
    for (doc_id, text), (spans, kept) in zip(rows, removed([t for _, t in rows], length)):
        out.append((doc_id, len((text or "").encode()), sum(e - b for b, e in spans), len(spans),
                    hashlib.sha256(kept).hexdigest()))
    return out


def pieces(rows: list[tuple]) -> list[tuple]:
    model, out = sp(), []
    for doc_id, text in rows:
        ids = [model.bos_id(), *model.encode(text or ""), model.eos_id()]
        out.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256(model.decode(ids).encode()).hexdigest()))
    return out


def inside_grams(words: list[str], n: int) -> set[int]:
    grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
    seen = Counter(grams)
    return {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(n)}


def quality(doc_id, text: str | None, limits: dict[int, int], line_limit: int) -> dict:
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    chars = sum(map(len, words))
    repeated = Counter(lines)
    dup_chars = sum((n - 1) * sum(map(len, WORD.findall(x))) for x, n in repeated.items())
    out = {"doc_id": doc_id, "n_words": len(words), "word_chars": chars,
           "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": len(lines) - len(repeated),
           "n_repeat_words": len(inside_grams(words, 5)), "dup_line_chars": dup_chars}
    for n in limits:
        out[f"gram{n}_chars"] = sum(len(words[i]) for i in inside_grams(words, n))
    out["base_failed"] = len(words) < 10 or 100 * out["n_repeat_words"] > 20 * len(words)
    out["kept"] = not out["base_failed"] and 100 * dup_chars <= line_limit * chars and all(
        100 * out[f"gram{n}_chars"] <= limit * chars for n, limit in limits.items())
    return out


def sections(doc_id, text: str | None, tokenizer, rule: str) -> list[tuple]:
    """(doc_id, section, begins, ends, tokens, crossing), from the library's own offsets."""
    text = text or ""
    sizes = [len(x) + 1 for x in text.split("\n")]
    sizes[-1] -= 1
    if len(sizes) > 1 and not sizes[-1]:
        sizes.pop()
    edges = np.cumsum([0, *sizes])
    counts, crossing = defaultdict(float), defaultdict(int)
    for begin, end in tokenizer.encode(text, add_special_tokens=False).offsets:
        shares = {s: min(end, edges[s + 1]) - max(begin, edges[s]) for s in range(len(sizes))}
        shares = {s: x for s, x in shares.items() if x > 0}
        if len(shares) > 1:
            for s in shares:
                crossing[s] += 1
        if rule == "shared":
            for s, x in shares.items():
                counts[s] += x / sum(shares.values())
        else:
            counts[min(shares) if rule == "first" else max(shares, key=lambda s: (shares[s], -s))] += 1
    return [(doc_id, s, edges[s], edges[s + 1], counts[s], crossing[s]) for s in range(len(sizes))]


def leaks(documents: list[tuple], items: list[tuple]) -> dict[tuple, tuple]:
    """(doc_id, item_id) to shingles found of question and answer, anywhere in one document."""
    def tokens(text):
        folded = "".join(c if ord(c) > 127 or c.isalnum() else " " for c in lower(text or ""))
        return [w for w in folded.split(" ") if w]

    def grams(words, size):
        return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}

    out = {}
    for doc_id, text in documents:
        words = tokens(text)
        for item_id, question, answer in items:
            parts = [tokens(question), tokens(answer)]
            asked = [grams(p, min(5, len(p))) if p else set() for p in parts]
            total = sum(map(len, asked))
            if not total:
                continue
            span = int(1.25 * sum(map(len, parts)) + 1) * 2
            for begin in range(0, max(len(words), 1)):
                window = words[begin:begin + span]
                got = [len(a & grams(window, min(5, len(p)))) if p else 0 for a, p in zip(asked, parts)]
                if (100 * sum(got) >= 80 * total
                        and all(100 * g >= 50 * len(a) for g, a in zip(got, asked))):
                    best = out.get((doc_id, item_id), (0, 0))
                    out[doc_id, item_id] = max(best, tuple(got), key=lambda h: (sum(h), h))
    return out
