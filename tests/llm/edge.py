"""Documents with every awkward case, and plain versions of what the operators compute."""

from __future__ import annotations

import random

WORDS = "river stone amber lantern quiet harbor velvet thunder maple copper window garden silver meadow orbit cedar".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = [rng.choice(WORDS) + rng.choice(["", "", "s", "ly", "ing"]) for _ in range(n)]
    return ". ".join(" ".join(words[i : i + 9]).capitalize() for i in range(0, n, 9)) + "."


PASSAGE = prose(1, 60)


def rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars, and columns with names that operators use themselves)."""
    texts: list[tuple] = [(k, prose(100 + k, 30 + 7 * k)) for k in range(25)]
    texts += [(30 + k, texts[3][1]) for k in range(5)]  # exact copies
    texts += [(40 + k, texts[4][1].replace("river", "canal", 1 + k % 2) + " End.") for k in range(4)]  # near copies
    texts += [(50 + k, f"{prose(500 + k, 40)}\n{PASSAGE}\n{prose(600 + k, 30)}") for k in range(6)]  # a shared passage
    texts += [(60, None), (61, ""), (62, " \t\n\x0b\x0c\r "), (63, "One."), (64, "two words"), (65, "é" * 40), (66, "a" * 3000), (67, "ab " * 900)]
    texts += [(68, prose(700, 6000)), (69, "x\x00y     line"), (70, "<|endoftext|> it's 42 don't 你好 naïve \U0001f600")]
    texts += [(71, "### *** $$$ %%% &&& " * 40), (None, prose(800, 60)), (None, None), (5, texts[5][1]), (6, prose(900, 80))]  # repeated rows and ids
    return [(k, t, "en", f"s{n % 3}", len(t or ""), "clash", n, "clash", "clash") for n, (k, t) in enumerate(texts)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket string, shard int, record string, node string"


def documents(spark, parts: int = 5):
    return spark.createDataFrame(rows(), SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def encoded(text) -> bytes:
    return (text or "").encode()
