"""Rows that every operator must take: NULLs, empty and long texts, repeats, clashing columns; and empty tables."""

from __future__ import annotations

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, vector string, held_out string, tokens string, row long"
PHRASE = "the quick brown fox jumps over the lazy dog while many small birds sing in the old green trees near the river and the town sleeps".split()


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(PHRASE) + (draw.choice(["", "", str(draw.randint(0, 99))])) for _ in range(words))


def texts() -> list[tuple]:
    """(doc_id, text, source)"""
    base = prose(1, 120)
    rows = [(1, base, "a"), (2, base, "b"), (3, base + " extra tail words", "a"), (4, None, "a"), (5, "", None), (6, " \n\t ", None), (None, prose(2, 80), "c"), (None, None, None),
            (7, prose(3, 3), "b"), (8, prose(3, 3), "c"), (9, "word " * 30_000, "a"), (10, "### $$$ &&& " * 40, "b"), (11, "Straße ÉTÉ naïve 漢字 😀 " * 12, ""), (1, base, "a"),
            (12, "mail a.b+c@x-y.example.com or call +1 (555) 123-4567 from 10.0.0.255 with 4111 1111 1111 1111 now", "c"),
            (13, "Released under the MIT License. " + prose(4, 60), "b"), (14, prose(5, 400), "a"), (15, prose(5, 395), "d")]
    return rows + [(100 + i, prose(100 + i, 60 + i), "ab"[i % 2]) for i in range(30)]


def documents(spark, rows=None):
    """A documents table with extra columns whose names clash with what operators make."""
    given = texts() if rows is None else rows
    return spark.createDataFrame([(i, t, None, s, None if t is None else len(t), 0.5, 7, "v", "h", "t", 1) for i, t, s in given], COLUMNS)


def nothing(spark):
    return spark.createDataFrame([], COLUMNS)
