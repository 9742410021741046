"""Texts that operators may stumble over."""

import random
from pathlib import Path

FOLDER = Path("/root/testdata/sf0.001")

# Columns that operators use for themselves.
CLASHING = "kept string, row int, fp string, digest string, place string, runs int, n long, shard string"


def sentence(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(words))


def odd_texts() -> list[tuple]:
    """Nulls, empty and blank texts, ties, copies, near copies, passages, one very long text."""
    shared, longer = sentence(1, 150), sentence(2, 400)
    texts = [
        None, "", "   \n\t ", "one", "two words", "Ünïcode ﬁ 漢字 🙂 end", "a" * 3000, "ab " * 700,
        longer, longer, longer.upper(), longer + " more", "x " + longer[:900] + " y", longer[5:] + longer,
        sentence(3, 40) + "\n" + shared + "\n" + sentence(4, 40), shared + " " + sentence(5, 60),
        sentence(6, 30) + "\n" + sentence(7, 9) + "\n" + sentence(7, 9) + "\n\n\n" + sentence(8, 20),
        " lead  and   trail  ", "\x00 null \x1c sep  nb\xa0 sp", "<|endoftext|> <s> ▁▁ marks ▁",
        "é" * 500, "# $ % & | < > *" * 30, sentence(9, 30_000), "\r\n".join(sentence(k, 12) for k in range(40)),
    ]
    rows = [(k + 10, t) for k, t in enumerate(texts)]
    rows += [(None, longer), (None, None), (17, "ab " * 700), (17, "ab " * 700), (5, sentence(10, 80))]
    return rows
