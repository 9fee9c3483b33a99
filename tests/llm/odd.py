"""Texts and rows that every operator must take."""

from __future__ import annotations

PROSE = "the quick brown fox jumps over the lazy dog while a slow green turtle walks under the old wooden bridge near town"


def odd_rows(word: str = "word"):
    """Null and empty texts, blanks, a null id, repeated rows, a null source and a very long text."""
    return [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n\n ", None, None), (None, PROSE, "en", "b"), (5, PROSE, "en", "b"),
        (5, PROSE, "en", "b"), (6, "Short.", "en", None), (7, " ".join(f"{word}{i % 5000}" for i in range(60_000)), "en", "a"), (8, "x" * 300_000, None, "c"),
    ]
