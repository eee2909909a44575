"""Small documents with every odd case, and brute-force versions of what SQL cannot express."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, score double, length long, piece string"


def word(rng: random.Random) -> str:
    return "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8)))


def prose(rng: random.Random, n: int) -> str:
    return " ".join(word(rng) for _ in range(n))


def odd_rows(seed: int = 1, n: int = 24) -> list[tuple]:
    """Prose, near copies, shared lines, empty, null, blank and long texts, a repeated row and a null id; extra columns clash with names that operators use."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(20, 120)) for _ in range(n)]
    line = "  A line that MANY documents have in common \t"
    texts[3] = texts[2]
    texts[4] = texts[2] + " one more"
    texts[5] = texts[5] + "\n" + line
    texts[6] = line.strip().lower() + "\n" + texts[6] + "\n" + line
    texts[7] = texts[7] + "\n" + line.upper()
    texts[8] = texts[8][:40] + texts[9] + texts[8][40:]
    texts[10], texts[11], texts[12], texts[13] = "", None, " \t\n ", "ab ab"
    texts[14] = "é😀ü " * 300 + prose(rng, 3000)
    texts[15] = "la la la la " * 60
    rows = [(i, x, ("xx", "yy", None)[i % 3], "s", None, "k", 0.5, 7, "p") for i, x in enumerate(texts)]
    return [*rows, rows[2], (None, texts[2], None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]


def texts_by_id(rows: list[tuple]) -> list[tuple]:
    return [(r[0], r[1]) for r in rows]
