"""Byte-level BPE of whole texts, each distinct piece of a task's texts encoded once."""

from __future__ import annotations

import json
import os
import re
import struct

import numpy as np
import public_tokenizers

BYTE_BPE = "byte_bpe_50k.json"
# Words remembered by a worker, with the signs around them and without; beyond it a table starts
# anew, which costs time only.
REMEMBERED, PARTS = 300_000, 1_000_000

# The tokenizer first cuts a text so that a space opens the next word. A cut before a space is
# safe if no white space stands before that space: no token spans it, and no rule looks past it.
# Where all white space is single spaces and line ends, a line end is a token by itself, too.
_CUT = re.compile(r"(?<=\S)(?= \S)")
_JOINED = ("  ", "\n ", " \n", "\n\n", "\t", "\r", "\x0b", "\x0c")
_OTHER_SPACE = re.compile(
    r"[\x1c-\x1f\x85\xa0  -     　]")
# ASCII signs: together, without letters, digits or space between them, they make up one cut.
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _alphabet() -> dict[int, int]:
    """The letter that stands for each byte: printable ones for themselves, the others above."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + k for k, b in enumerate(others)}


_LETTERS = _alphabet()
_encoders: dict[str, Encoder] = {}


class Encoder:
    """The tokenizer of a file, with a table of the pieces seen lately.

    Only a byte-level tokenizer that cuts by the rule above is taken apart; with any other,
    texts are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        cutting = json.loads(self.tokenizer.to_str())
        rule = cutting["pre_tokenizer"] or {}
        self.separable = (
            rule.get("type") == "ByteLevel" and rule.get("use_regex") and not rule.get("add_prefix_space")
            and not cutting["normalizer"]
            and not any(plain(t["content"]) for t in cutting["added_tokens"]))
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.form = "<%dH" if self.dtype.itemsize == 2 else "<%dI"
        self.line_end = self.whole("\n")
        self.after_space: dict[str, bytes] = {}  # by word, the ids of a space and the word
        self.others: dict[str, bytes] = {}  # by piece
        self.parts: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, packed in ``dtype``."""
        if not self.separable:
            return [self.whole(t) for t in texts]
        if len(self.after_space) > REMEMBERED:
            self.after_space = {}
        if len(self.others) > REMEMBERED:
            self.others = {}
        if len(self.parts) > PARTS:
            self.parts = {}
        return [self.text(t) for t in texts]

    def text(self, text: str) -> bytes:
        if any(x in text for x in _JOINED) or _OTHER_SPACE.search(text):
            return b"".join([self.other(p) for p in _CUT.split(text)])
        out, seen = [], self.after_space.get
        for number, line in enumerate(text.split("\n")):
            if number:
                out.append(self.line_end)
            first, *words = line.split(" ")
            out.append(self.other(first))
            ids = list(map(seen, words))
            if None in ids:
                at = -1
                for _ in range(ids.count(None)):
                    at = ids.index(None, at + 1)
                    # it may have been met earlier in this line
                    known = seen(words[at])
                    ids[at] = self.piece(" " + words[at]) if known is None else known
                    self.after_space[words[at]] = ids[at]
            out += ids
        return b"".join(out)

    def pack(self, ids: list[int]) -> bytes:
        return struct.pack(self.form % len(ids), *ids)

    def whole(self, text: str) -> bytes:
        return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def other(self, piece: str) -> bytes:
        ids = self.others.get(piece)
        if ids is None:
            ids = self.others[piece] = self.piece(piece)
        return ids

    def piece(self, piece: str) -> bytes:
        """Encode a piece that is in no table.

        A word of letters, with a space before and ASCII signs behind it, or neither, is cut
        by the tokenizer before the signs and nowhere else, so its two parts can be given to the
        library's merges as they are. Words differ by their signs more often than not, so parts
        are remembered, too.
        """
        if not plain(piece):
            return self.whole(piece)
        word = piece.rstrip(_SIGNS)
        if word in (" ", "", piece):
            return self.part(piece)
        return self.part(word) + self.part(piece[len(word):])

    def part(self, text: str) -> bytes:
        ids = self.parts.get(text)
        if ids is None:
            letters = text.encode().decode("latin-1").translate(_LETTERS)
            ids = self.parts[text] = self.pack([t.id for t in self.model.tokenize(letters)])
        return ids


def plain(piece: str) -> bool:
    """Whether a piece is letters, then ASCII signs, one of them at least, and maybe a space before."""
    word = piece[1:] if piece[:1] == " " else piece
    letters = word.rstrip(_SIGNS)
    return word != "" and (letters == "" or letters.isalpha())


def encoder(path: str | None = None) -> Encoder:
    """One encoder per worker and file."""
    path = path or public_tokenizers.path(BYTE_BPE)
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
