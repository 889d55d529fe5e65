"""Edit distances on short strings, for use inside Arrow batches."""

from __future__ import annotations

import unicodedata


def fold(text: str) -> str:
    """Lower case without accents."""
    if text.isascii():
        return text.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()


def within(a: str, b: str, most: int) -> int:
    """Edit distance with neighbouring swaps (each position edited once); ``most + 1`` if it is larger than ``most``."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        least = i
        for j, y in enumerate(b, 1):
            v = min(row[j] + 1, now[j - 1] + 1, row[j - 1] + (x != y))
            if x != y and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            now.append(v)
            if v < least:
                least = v
        if least > most:
            return most + 1
        before, row = row, now
    return min(row[-1], most + 1)
