"""Mapping freely typed values to a canonical list of military units.

Typed values are brought to plain tokens (numbers, whole state names, whole branch names; tokens one
or two edits from a word of the list are corrected). A multi-pattern automaton over the canonical names
and aliases, in all their usual word orders, finds the mentions inside the value, and the longest
that do not overlap win. What is left goes to token-set similarity.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollweave.llm.edits import fold, within

LIST_BOUND = 50_000  # entries the canonical list may have: it is sent to every task

# fixed values: states with the abbreviations in use, and branches with theirs
STATES = {
    "alabama": "al ala", "arkansas": "ar ark", "florida": "fl fla flor", "georgia": "ga geo", "kentucky": "ky ken kent", "louisiana": "la lou", "mississippi": "ms miss", "missouri": "mo",
    "northcarolina": "nc ncar", "southcarolina": "sc scar", "tennessee": "tn tenn ten", "texas": "tx tex", "virginia": "va virg", "maryland": "md", "indiana": "in ind", "illinois": "il ill", "ohio": "oh", "iowa": "ia",
    "kansas": "ks kan kans", "newyork": "ny", "pennsylvania": "pa penn", "michigan": "mi mich", "wisconsin": "wi wis wisc", "minnesota": "mn minn", "delaware": "de", "massachusetts": "mass", "connecticut": "ct conn", "westvirginia": "wv wva",
    "newjersey": "nj", "maine": "me", "vermont": "vt", "newhampshire": "nh", "rhodeisland": "ri", "nebraska": "ne neb", "california": "cal calif", "oregon": "ore",
}
BRANCHES = {
    "infantry": "inf infty infy infant", "cavalry": "cav cavy cavly calvary calv", "artillery": "art arty artil", "light": "lt", "mounted": "mtd m mntd", "rifles": "rif rifle riflemen rifleman rfls", "legion": "legio leg",
    "sharpshooters": "sharp sharpshooter", "partisan": "parti part", "rangers": "ranger rang", "scouts": "scout", "guards": "guard", "home": "", "regiment": "regt reg rgt", "volunteers": "vols vol volunteer",
}
COMPOUND_STATES = {("north", "carolina"): "northcarolina", ("south", "carolina"): "southcarolina", ("new", "york"): "newyork", ("west", "virginia"): "westvirginia", ("new", "jersey"): "newjersey", ("new", "hampshire"): "newhampshire", ("rhode", "island"): "rhodeisland"}
COMPOUND_BRANCHES = {("light", "artillery"): "lightartillery", ("artillery", "light"): "lightartillery", ("mounted", "rifles"): "mountedrifles", ("partisan", "rangers"): "partisanrangers", ("home", "regiment"): "homeregiment"}
UNITS = ["first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth"]
TEENS = ["tenth", "eleventh", "twelfth", "thirteenth", "fourteenth", "fifteenth", "sixteenth", "seventeenth", "eighteenth", "nineteenth"]
TENS = ["twent", "thirt", "fort", "fift", "sixt", "sevent", "eight", "ninet"]
JOINERS = {"and", "later", "then", "also", "afterwards", "formerly", "or"}


def _ordinals() -> dict[str, int]:
    out = {w: i for i, w in enumerate(UNITS, 1)} | {w: i for i, w in enumerate(TEENS, 10)}
    for i, t in enumerate(TENS, 2):
        out[f"{t}ieth"] = 10 * i
        out |= {f"{t}y{u}": 10 * i + k for k, u in enumerate(UNITS, 1)}
    return out


class Gazetteer:
    """The canonical list, ready for lookups.

    ``entries``: (id, name, state code, number or None, branch, alias or None).
    """

    def __init__(self, entries: list[tuple[int, str, str | None, int | None, str | None, str | None]]):
        self.ordinals = _ordinals()
        self.word = {s: s for s in STATES} | {b: b for b in BRANCHES}
        for full, short in (STATES | BRANCHES).items():
            self.word |= {a: full for a in short.split()}
        self.word |= {w: w for pair in COMPOUND_STATES for w in pair} | {j: "and" for j in JOINERS}
        self.codes = {a.upper(): s for s, short in STATES.items() for a in short.split() if len(a) == 2}
        self.names: set[str] = set()
        for entry in entries:
            for text in (entry[1], entry[5] or ""):
                for w in re.findall(r"[a-z]+", re.sub(r"[^a-z0-9 ]", "", re.sub(r"['’]s\b", "", fold(text)))):
                    if w not in self.word and len(w) > 3:
                        self.names.add(w)
        self.lexicon: dict[int, list[str]] = {}
        for w in {*STATES, *(w for b in BRANCHES for w in (b, *BRANCHES[b].split()) if len(w) > 4), *self.names, *(w for pair in COMPOUND_STATES for w in pair), *self.ordinals}:
            self.lexicon.setdefault(len(w), []).append(w)
        self.branches = {*COMPOUND_BRANCHES.values(), *BRANCHES}
        self._corrected: dict[str, str] = {}
        self.sets: list[tuple[int, frozenset[str], str | None]] = []
        self.place: dict[int, tuple[str, int | None]] = {}

        patterns: dict[str, set[int]] = {}
        short: dict[str, set[int]] = {}
        for key, name, code, number, branch, alias in entries:
            state = self.codes.get((code or "").upper(), "")
            self.place[key] = state, number
            whole = self.tokens(name)
            self.sets.append((key, frozenset(whole), None if number is None else str(number)))
            own = [t for t in whole if t in self.names]
            kind = [t for t in whole if t in self.branches]
            orders = [whole]
            if number is not None and kind:
                n, k = str(number), kind
                orders += [[n, state, *k], [state, *k, n], [state, n, *k], [*k, n, state], [*k, state, n], [n, *k, state]]
                for o in ([n, state], [state, n]):
                    short.setdefault(" ".join(o), set()).add(key)
            elif own and kind:
                orders += [[*own, state, *kind], [*own, *kind, state], [state, *own, *kind], [*kind, state, *own], [*own, *kind], [*kind, *own], [*kind, *own, state]]
            for o in orders:
                patterns.setdefault(" ".join(t for t in o if t), set()).add(key)
            if alias:
                a = self.tokens(alias)
                tail = a[-1:]
                for o in (a, [*a, state], [state, *a], [*a[:-1], state, *tail], [*tail, state, *a[:-1]]):
                    patterns.setdefault(" ".join(t for t in o if t), set()).add(key)
        self.numbered = set(self.place.values())
        self.holding: dict[str, list[int]] = {}  # word -> places in sets
        for at, (_, words, _) in enumerate(self.sets):
            for w in words:
                self.holding.setdefault(w, []).append(at)
        self._near: dict[str, list[str]] = {}
        self.automaton = ahocorasick.Automaton()
        for text, keys in patterns.items():
            if len(keys) == 1 and " " in text:  # a pattern that fits several entries names none of them
                self.automaton.add_word(f" {text} ", (len(text) + 2, next(iter(keys)), False))
        for text, keys in short.items():
            if len(keys) == 1 and text not in patterns:
                self.automaton.add_word(f" {text} ", (len(text) + 2, next(iter(keys)), True))
        self.any = len(self.automaton) > 0
        if self.any:
            self.automaton.make_automaton()

    def correct(self, w: str) -> str:
        """The word of the lexicon that ``w`` is a misspelling of, else ``w``."""
        if w in self.word:
            return self.word[w]
        if w in self.names or w.isdigit() or len(w) < 4:
            return w
        known = self._corrected.get(w)
        if known is None:
            for form in (w, w[:-1]) if w.endswith("s") else (w,):
                if form in self.names:
                    known = form
                    break
            else:
                best = []
                most = 1 if len(w) < 7 else 2
                for n in range(len(w) - most, len(w) + most + 1):
                    for x in self.lexicon.get(n, ()):
                        d = within(w, x, most)
                        if d <= most:
                            best.append((d, x))
                best.sort()
                known = w
                if best and (len(best) == 1 or best[0][0] < best[1][0] or self.word.get(best[0][1]) == self.word.get(best[1][1]) is not None):
                    known = self.word.get(best[0][1], best[0][1])
            if len(self._corrected) > 200_000:
                self._corrected.clear()
            self._corrected[w] = known
        return known

    def tokens(self, text: str) -> list[str]:
        """The plain tokens of a typed value."""
        t = fold(text).replace("’", "'")
        t = re.sub(r"\bc\.?\s*s\.?\s*a\b\.?", " ", t)
        t = re.sub(r"\bco(?:mpany)?\.?\s+[a-z]\b", " ", t)
        t = re.sub(r"\b([ns])\.?\s*c(?:ar)?\b\.?", r" \1c ", t)
        t = re.sub(r"\bn\.?\s*y\b\.?", " newyork ", t)
        t = re.sub(r"'s\b", "", t).replace("'", "")
        t = re.sub(r"\b[il](?=st\b)", "1", t)
        t = re.sub(r"(?<=[a-z])0(?=[a-z])", "o", t)
        t = re.sub(r"(?<=[a-z])1(?=[a-z])", "l", t)
        t = re.sub(r"(?<=\d)\s*(?:st|nd|rd|th|d)\b\.?", " ", t)
        t = re.sub(r"[&+;/]", " and ", t)
        out: list[str] = []
        raw = re.findall(r"[a-z]+-[a-z]+|[a-z]+|\d+", t)
        for w in raw:
            if "-" in w:
                joined = w.replace("-", "")
                parts = [joined] if joined in self.ordinals or self.correct(joined) in self.ordinals else w.split("-")
            else:
                parts = [w]
            for p in parts:
                p = p if p in self.ordinals else self.correct(p)
                out.append(str(self.ordinals[p]) if p in self.ordinals else str(int(p)) if p.isdigit() else p)
        joined_ = []
        for w in out:  # compound words, then fillers
            for table in (COMPOUND_STATES, COMPOUND_BRANCHES):
                if joined_ and (joined_[-1], w) in table:
                    joined_[-1] = table[joined_[-1], w]
                    break
            else:
                if joined_ and joined_[-1].isdigit() and w.isdigit() and int(joined_[-1]) % 10 == 0 and int(w) < 10 and len(joined_[-1]) == 2 and not re.search(r"\d", text):
                    joined_[-1] = str(int(joined_[-1]) + int(w))  # "twenty first" written apart
                else:
                    joined_.append(w)
        return [w for i, w in enumerate(joined_) if w not in ("volunteers", "of", "the") and not (w == "regiment" and not (i and joined_[i - 1] in self.names or len(joined_) == i + 2 and joined_[i + 1] in self.names))]

    def spread(self, tokens: list[str]) -> list[str]:
        """Numbers that share what follows or precedes them each get it: ``8 and 46 x y`` is ``8 x y and 46 x y``."""
        i, out = 0, []
        while i < len(tokens):
            j, numbers = i, []
            while j < len(tokens) and tokens[j].isdigit():
                numbers.append(tokens[j])
                j += 1
                if j + 1 < len(tokens) and tokens[j] == "and" and tokens[j + 1].isdigit():
                    j += 1
            if len(numbers) > 1:
                end = j
                while end < len(tokens) and tokens[end] != "and" and not tokens[end].isdigit():
                    end += 1
                tail = tokens[j:end]
                start = len(out)
                while start > 0 and out[start - 1] != "and" and not out[start - 1].isdigit():
                    start -= 1
                head = out[start:] if not tail else []
                del out[len(out) - len(head) :]
                for n in numbers:
                    out += [*head, n, *tail, "and"]
                i = end
            else:
                out.append(tokens[i])
                i += 1
        return out

    def mentions(self, text: str) -> list[int]:
        """The ids of the listed units that the value names, in ascending order; empty if none."""
        tokens = self.spread(self.tokens(text))
        line = f" {' '.join(tokens)} "
        hits = []
        if self.any:
            for end, (length, key, bare) in self.automaton.iter(line):
                start = end - length + 1
                if bare:  # without a branch it holds only where no branch stands next to it
                    after, before = line[end + 1 :].split(" ", 1)[0], line[: start + 1].rstrip().rsplit(" ", 1)[-1]
                    if after in self.branches or before in self.branches:
                        continue
                hits.append((-length, start, end, key))
        taken: list[tuple[int, int]] = []
        found: set[int] = set()
        for _, start, end, key in sorted(hits):
            if all(end - 1 < a or start + 1 > b for a, b in taken):
                taken.append((start + 1, end - 1))
                found.add(key)
        return sorted(found) or self.similar(tokens)

    def near_words(self, token: str) -> list[str]:
        """The words of the list that a token is, begins, begins with, or is within two edits of."""
        known = self._near.get(token)
        if known is None:

            def near(w: str) -> bool:
                least = min(len(token), len(w))
                return token == w or not token.isdigit() and not w.isdigit() and (least >= 3 and (token.startswith(w) or w.startswith(token)) or least >= 5 and within(token, w, 2) <= 2)

            if len(self._near) > 100_000:
                self._near.clear()
            known = self._near[token] = [w for w in self.holding if near(w)]
        return known

    def similar(self, tokens: list[str]) -> list[int]:
        """Token-set similarity for what the automaton didn't find: the one entry with the same number and, softly, nearly all the same words."""
        numbers = [t for t in tokens if t.isdigit()]
        mine = {t for t in tokens if t != "and"}
        if len(mine) < 2:
            return []

        shared: dict[int, set[str]] = {}  # entry -> its words that the value has, softly
        for token in mine:
            for w in self.near_words(token):
                for at in self.holding[w]:
                    shared.setdefault(at, set()).add(w)
        best = []
        for at, found in shared.items():
            key, words, number = self.sets[at]
            if len(found) < len(words) or (number not in numbers if number is not None else numbers):
                continue
            score = 2 * len(words) / (len(words) + len(mine))
            if score >= 0.8:
                best.append((-score, key))
        best.sort()
        return [best[0][1]] if best and (len(best) == 1 or best[0][0] < best[1][0]) else []


@lru_cache(maxsize=4)
def _gazetteer(entries: tuple) -> Gazetteer:
    return Gazetteer(list(entries))


def map_to_list(values: DataFrame, record_id: str, value: str, canonical: DataFrame, entry_id: str, name: str, state: str, number: str, branch: str, alias: str) -> DataFrame:
    """``record_id, entry_id``: a row per listed unit that a record's value names, or one with 0 if it names none.

    Null and blank values give no row; repeated rows count once; a record with two values has the
    units of both. An empty list leaves every value at 0. Only distinct values are looked up. The list is
    sent to every task and must have at most ``LIST_BOUND`` entries, which is checked.
    """
    listed = [tuple(r) for r in canonical.select(entry_id, name, state, number, branch, alias).where(F.col(name).isNotNull()).limit(LIST_BOUND + 1).collect()]
    if len(listed) > LIST_BOUND:
        raise ValueError(f"the canonical list has more than {LIST_BOUND} entries")
    entries = tuple(sorted(set(listed), key=lambda r: r[0]))

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _gazetteer(entries)
        for batch in batches:
            ids = [known.mentions(v) or [0] for v in batch["value"]]
            yield pd.DataFrame({"value": batch["value"], "ids": ids})

    typed = values.select(F.col(record_id).cast("long").alias("record_id"), F.col(value).alias("value")).where(F.col("value").isNotNull() & (F.regexp_replace("value", r"[\s\p{Z}\p{C}]+", "") != "")).distinct()
    looked = typed.select("value").distinct().mapInPandas(look, "value string, ids array<long>")
    rows = typed.join(looked, "value").select("record_id", F.explode("ids").alias("entry_id")).distinct()
    several = rows.groupBy("record_id").agg(F.max("entry_id").alias("top"))
    return rows.join(several, "record_id").where("entry_id <> 0 or top = 0").select("record_id", "entry_id")
