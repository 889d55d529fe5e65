"""Phonetic codes and string similarities.

The three Soundex variants are column expressions. Metaphone, NYSIIS and Jaro-Winkler have no
built-in counterpart and run as Arrow functions; apply them to distinct names.
"""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from rollweave.functions.text import ColumnLike, fold_accents, normalise, text

# fixed values: the digit of each letter; 0 interrupts a run of equal digits
LETTERS, DIGITS = "abcdefghijklmnopqrstuvwxyz", "01230120022455012623010202"


def _code(letter: Column, digits: Column) -> Column:
    return F.substring(F.rpad(F.concat(F.upper(letter), F.regexp_replace(F.regexp_replace(digits, r"(.)\1+", "$1"), "0", "")), 4, "0"), 1, 4)


def soundex(x: ColumnLike) -> Column:
    """Soundex whose first letter never absorbs a follower, and in which vowels, h and w part equal digits; '' if empty."""
    n = normalise(x)
    return F.when(n == "", "").otherwise(_code(F.substring(n, 1, 1), F.translate(F.substring(n, 2, 1_000_000), LETTERS, DIGITS)))


def soundex_seeded(x: ColumnLike) -> Column:
    """Soundex whose first letter absorbs followers of its digit; whatever has no digit parts runs."""
    t = F.lower(F.trim(text(x)))
    digits = F.regexp_replace(F.translate(t, LETTERS, DIGITS), "[^1-6]", "0")
    runs = F.regexp_replace(digits, r"(.)\1+", "$1")
    return F.when(t == "", "").otherwise(F.substring(F.rpad(F.concat(F.upper(F.substring(t, 1, 1)), F.regexp_replace(F.substring(runs, 2, 1_000_000), "0", "")), 4, "0"), 1, 4))


def soundex_sticky(x: ColumnLike) -> Column:
    """Soundex in which nothing parts equal digits."""
    n = normalise(x)
    digits = F.regexp_replace(F.translate(F.substring(n, 2, 1_000_000), LETTERS, DIGITS), "0", "")
    return F.when(n == "", "").otherwise(_code(F.substring(n, 1, 1), digits))


def jaro(a: str, b: str) -> float:
    """Jaro similarity of two non-empty strings."""
    if a == b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, hits = [False] * len(b), []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == x:
                used[j] = True
                hits.append(x)
                break
    m = len(hits)
    if not m:
        return 0.0
    swapped = sum(x != y for x, y in zip(hits, (y for j, y in enumerate(b) if used[j]))) // 2
    return (m / len(a) + m / len(b) + (m - swapped) / m) / 3


def jaro_winkler(a: str, b: str, gate: float = 0.0) -> float:
    """Jaro-Winkler similarity; the common prefix counts only where the Jaro similarity exceeds ``gate``."""
    j = jaro(a, b)
    if j <= gate:
        return j
    p = 0
    while p < min(4, len(a), len(b)) and a[p] == b[p]:
        p += 1
    return j + 0.1 * p * (1 - j)


@F.pandas_udf(DoubleType())
def _gated(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([0.0 if not x or not y else jaro_winkler(x, y, 0.7) for x, y in zip(a, b)])


@F.pandas_udf(DoubleType())
def _boosted(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([1.0 if not x and not y else 0.0 if not x or not y else jaro_winkler(x, y) for x, y in zip(a, b)])


def name_similarity(a: ColumnLike, b: ColumnLike) -> Column:
    """Jaro-Winkler of the normalised names, prefix counted above 0.7; 0 if either is empty."""
    return _gated(normalise(a), normalise(b))


def first_name_similarity(a: ColumnLike, b: ColumnLike) -> Column:
    """Jaro-Winkler of the accent-folded names, prefix always counted; two empty names are alike."""
    return _boosted(fold_accents(a), fold_accents(b))


@lru_cache(maxsize=200_000)
def metaphone_word(name: str) -> str:
    """Metaphone code of a word (after Lawrence Philips' published rules)."""
    w = "".join(c for c in name.lower() if "a" <= c <= "z")
    if not w:
        return ""
    if w[:2] in ("kn", "gn", "pn", "wr", "ae"):
        w = w[1:]
    elif w[0] == "x":
        w = "s" + w[1:]
    elif w[:2] == "wh":
        w = "w" + w[2:]
    out, vowels, n, i = [], "aeiou", len(w), 0
    at = lambda k: w[k] if 0 <= k < n else ""
    while i < n:
        c, nxt, prev = w[i], at(i + 1), at(i - 1)
        if c == prev and c != "c":
            i += 1
            continue
        if c in vowels:
            if i == 0:
                out.append(c)
        elif c == "b":
            if not (prev == "m" and i == n - 1):
                out.append("b")
        elif c == "c":
            if nxt == "i" and at(i + 2) == "a" or nxt == "h":
                out.append("k" if nxt == "h" and prev == "s" else "x")
                i += nxt == "h"
            elif nxt and nxt in "iey":
                if prev != "s":
                    out.append("s")
            else:
                out.append("k")
        elif c == "d":
            if nxt == "g" and at(i + 2) and at(i + 2) in "iey":
                out.append("j")
                i += 2
            else:
                out.append("t")
        elif c == "g":
            if nxt == "h":
                if not (i + 2 < n and at(i + 2) not in vowels) and i + 2 < n:
                    out.append("k")
                i += 1
            elif nxt == "n":
                if not (i + 2 == n or w[i + 2 :] == "ed"):
                    out.append("k")
            elif nxt and nxt in "iey" and prev != "g":
                out.append("j")
            else:
                out.append("k")
        elif c == "h":
            if not (prev and prev in "csptg") and nxt and nxt in vowels:
                out.append("h")
        elif c == "k":
            if prev != "c":
                out.append("k")
        elif c == "p":
            out.append("f" if nxt == "h" else "p")
            i += nxt == "h"
        elif c == "q":
            out.append("k")
        elif c == "s":
            if nxt == "h":
                out.append("x")
                i += 1
            elif nxt == "i" and at(i + 2) in ("o", "a"):
                out.append("x")
            else:
                out.append("s")
        elif c == "t":
            if nxt == "i" and at(i + 2) in ("o", "a"):
                out.append("x")
            elif nxt == "h":
                out.append("0")
                i += 1
            elif not (nxt == "c" and at(i + 2) == "h"):
                out.append("t")
        elif c == "v":
            out.append("f")
        elif c in "wy":
            if nxt and nxt in vowels:
                out.append(c)
        elif c == "x":
            out.append("ks")
        elif c == "z":
            out.append("s")
        else:
            out.append(c)
        i += 1
    return "".join(out).upper()


@lru_cache(maxsize=200_000)
def nysiis_word(name: str) -> str:
    """NYSIIS code of a word (after the published New York State rules)."""
    w = "".join(c for c in name.upper() if "A" <= c <= "Z")
    if not w:
        return ""
    for a, b in (("MAC", "MCC"), ("KN", "N"), ("K", "C"), ("PH", "FF"), ("PF", "FF"), ("SCH", "SSS")):
        if w.startswith(a):
            w = b + w[len(a) :]
            break
    for a, b in (("EE", "Y"), ("IE", "Y"), ("DT", "D"), ("RT", "D"), ("RD", "D"), ("NT", "D"), ("ND", "D")):
        if w.endswith(a):
            w = w[: -len(a)] + b
            break
    key, chars, i = w[0], list(w), 1
    vowels = "AEIOU"
    while i < len(chars):
        c, nxt = chars[i], chars[i + 1] if i + 1 < len(chars) else ""
        prev = chars[i - 1]
        if c == "E" and nxt == "V":
            new = ["A", "F"]
        elif c in vowels:
            new = ["A"]
        elif c == "Q":
            new = ["G"]
        elif c == "Z":
            new = ["S"]
        elif c == "M":
            new = ["N"]
        elif c == "K":
            new = ["N"] if nxt == "N" else ["C"]
        elif c == "S" and "".join(chars[i : i + 3]) == "SCH":
            new = ["S", "S", "S"]
        elif c == "P" and nxt == "H":
            new = ["F", "F"]
        elif c == "H" and (prev not in vowels or nxt not in vowels or not nxt):
            new = [prev]
        elif c == "W" and prev in vowels:
            new = [prev]
        else:
            new = [c]
        chars[i : i + len(new)] = new
        if chars[i] != key[-1]:
            key += chars[i]
        i += 1
    if key.endswith("S") and len(key) > 1:
        key = key[:-1]
    if key.endswith("AY"):
        key = key[:-2] + "Y"
    if key.endswith("A") and len(key) > 1:
        key = key[:-1]
    return key


@F.pandas_udf(StringType())
def _metaphone(x: pd.Series) -> pd.Series:
    return x.map(metaphone_word)


@F.pandas_udf(StringType())
def _nysiis(x: pd.Series) -> pd.Series:
    return x.map(nysiis_word)


def metaphone(x: ColumnLike) -> Column:
    """Metaphone code; '' for null and for text without letters."""
    return _metaphone(text(x))


def nysiis(x: ColumnLike) -> Column:
    """NYSIIS code; '' for null and for text without letters."""
    return _nysiis(text(x))


def combined_score(a: ColumnLike, b: ColumnLike, similarity: Column, same_metaphone: Column, same_nysiis: Column) -> Column:
    """Weighted blend of name signals: 1 for equal names, 0 if either is empty; the codes are computed once per name by the caller."""
    x, y = normalise(a), normalise(b)
    signal = lambda c, w: F.when(F.coalesce(c, F.lit(False)), w).otherwise(0.0)
    blend = 0.5 * similarity + signal(same_metaphone, 0.15) + signal(same_nysiis, 0.15) + signal(soundex(a) == soundex(b), 0.05) + signal(F.startswith(x, y) | F.startswith(y, x), 0.05)
    return F.when((x == "") | (y == ""), 0.0).when(x == y, 1.0).otherwise(F.least(blend, F.lit(1.0)))
