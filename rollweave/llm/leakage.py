"""Evaluation texts leaking into training text, found with suffix arrays of the training text.

Training text is read shard by shard. The suffixes of a shard that can match at all are sorted; every
suffix of the test items is binary-searched among them, which gives all locations that share its first
words, and from there the longest verbatim matches. Item and document pairs with several such
locations are then aligned, to tell a passage that is exact or lightly altered from other text in the
same style: names and numbers that differ are other facts.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollweave.llm.edits import within

SHARD_WORDS = 400_000  # words of one suffix array
SLICE_CHARS = 4_000_000  # characters of test items sent to the tasks at once; more items take more passes
SEED = 4  # words that a located suffix shares
LEAST_WORDS = 15  # words of an item that make a leak
MATCH, CORRECTED, OTHER_WORD, OTHER_FACT, GAP = 1.0, 0.6, -1.3, -4.0, -0.9
FACT_GAP = OTHER_FACT - GAP  # a fact left out costs as much as another one in its place
WORD = re.compile(r"[a-z0-9]+")


def plain(text: str) -> str:
    """Lower case; accents, stray letters of other scripts and invisible characters dropped."""
    if text.isascii():
        return text.lower()
    t = unicodedata.normalize("NFKD", text).lower()
    return "".join(c for c in t if c.isascii() or not (unicodedata.combining(c) or c.isalpha() or unicodedata.category(c) in ("Cf", "Lm", "Lo")))


class Items:
    """The test items as one sequence of word numbers, with their sorted word pairs."""

    def __init__(self, items: list[tuple[int, str]]):
        self.number: dict[str, int] = {}
        self.ids = [i for i, _ in items]
        words, owner, fact = [], [], []
        for at, (_, text) in enumerate(items):
            ended = True
            for m in re.finditer(r"[^\W_]+", text):
                w = plain(m[0])
                if not WORD.fullmatch(w):
                    continue
                words.append(self.number.setdefault(w, len(self.number) + 1))
                owner.append(at)
                fact.append(w[0].isdigit() or m[0][0].isupper() and not ended)
                ended = text[m.end() : m.end() + 1] in ".?!:"
            words.append(0)
            owner.append(at)
            fact.append(False)
        names = {w for w, f in zip(words, fact) if f}  # a name is a name at a sentence's beginning too
        self.words, self.owner = np.array(words or [0], np.int64), np.array(owner or [0], np.int64)
        self.fact = np.array([f or w in names and w > 0 for f, w in zip(fact or [False], words or [0])])
        self.first = np.zeros(len(items) + 1, np.int64)
        self.first[1:] = np.cumsum(np.bincount(self.owner, minlength=len(items))[: len(items)]) if items else 0
        self.base = len(self.number) + 1
        w = np.append(self.words, [0] * SEED)
        pair = np.where((w[:-1] > 0) & (w[1:] > 0), w[:-1] * self.base + w[1:], -1)
        self.pairs = np.unique(pair[pair >= 0])
        codes = self.codes(w)
        self.at = np.flatnonzero(codes >= 0)
        self.suffixes = codes[self.at]
        self.near: dict[str, list[str]] = {}
        for x in self.number:
            if len(x) >= 4 and not x.isdigit():
                for k in (x, *(x[:i] + x[i + 1 :] for i in range(len(x)))):
                    self.near.setdefault(k, []).append(x)
        self.known: dict[str, int] = {}

    def codes(self, w: np.ndarray) -> np.ndarray:
        """The place of the first ``SEED`` words of each suffix among those that test items have; -1 where they have none."""
        if not len(self.pairs) or len(w) <= SEED:
            return np.full(max(len(w) - SEED, 0), -1, np.int64)
        pair = np.where((w[:-1] > 0) & (w[1:] > 0), w[:-1] * self.base + w[1:], -1)
        rank = np.searchsorted(self.pairs, pair)
        rank[rank == len(self.pairs)] = 0
        rank = np.where(self.pairs[rank] == pair, rank, -1)
        a, b = rank[: len(w) - SEED], rank[2 : len(w) - SEED + 2]
        return np.where((a >= 0) & (b >= 0), a * len(self.pairs) + b, -1)

    def lookup(self, w: str) -> int:
        """The number of a word; negative for a word one edit from one; 0 for any other."""
        n = self.known.get(w)
        if n is None:
            n = self.number.get(w, 0)
            if not n and len(w) >= 4 and not w.isdigit():
                best = {x for k in (w, *(w[:i] + w[i + 1 :] for i in range(len(w)))) for x in self.near.get(k, ()) if within(w, x, 1) <= 1}
                n = -self.number[min(best)] if len(best) == 1 else 0
            if len(self.known) > 500_000:
                self.known.clear()
            self.known[w] = n
        return n


def align(items: Items, item: np.ndarray, windows: np.ndarray, sure: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment of each row: its score, and the item words from its first to its last match.

    ``windows``: word numbers of the documents' windows, one row per pair (0: another word); ``sure``: whether spelled so.
    """
    n, width = windows.shape
    longest = int((items.first[item + 1] - items.first[item]).max())
    before, begun = np.zeros((n, width + 1)), np.full((n, width + 1), -1, np.int32)
    best, span = np.zeros(n), np.zeros(n, np.int32)
    slope = GAP * np.arange(width + 1)
    rows = np.arange(n)
    for i in range(longest):
        at = items.first[item] + i
        inside = at < items.first[item + 1]
        at = np.minimum(at, len(items.words) - 1)
        w = np.where(inside, items.words[at], 0)
        other = np.where(items.fact[at], OTHER_FACT, OTHER_WORD)[:, None]
        hit = (windows == w[:, None]) & (w > 0)[:, None]
        gain = np.where(hit, np.where(sure, MATCH, CORRECTED), other)
        fresh = before[:, :-1] <= 0
        diagonal = np.where(fresh, 0.0, before[:, :-1]) + gain
        start = np.where(fresh, i, begun[:, :-1])
        up = before[:, 1:] + np.where(items.fact[at], FACT_GAP, GAP)[:, None]
        now, here = np.where(diagonal >= up, diagonal, up), np.where(diagonal >= up, start, begun[:, 1:])
        now = np.concatenate([np.zeros((n, 1)), now], axis=1)
        here = np.concatenate([np.full((n, 1), -1, np.int32), here.astype(np.int32)], axis=1)
        lifted = now - slope  # a run of extra document words costs a gap each
        peak = np.maximum.accumulate(lifted, axis=1)
        source = np.maximum.accumulate(np.where(lifted >= peak, np.arange(width + 1), 0), axis=1)
        now, here = peak + slope, np.take_along_axis(here, source, axis=1)
        now = np.where(now > 0, now, 0.0)
        top = now.argmax(axis=1)
        value = now[rows, top]
        better = inside & (value > best)
        best = np.where(better, value, best)
        span = np.where(better, i + 1 - here[rows, top], span)
        before, begun = now, here
    return best, span


def search_shard(items: Items, texts: list[str | None]) -> list[tuple[int, int, int, float, int]]:
    """``(item, text, longest verbatim match, score, span)`` of the pairs of a shard with enough located suffixes, by place."""
    numbers: list[int] = []
    ends = [0]
    for t in texts:
        if t:
            numbers += map(items.lookup, WORD.findall(plain(t)))
        numbers += [0] * SEED
        ends.append(len(numbers))
    signed = np.array(numbers + [0] * SEED, np.int64)
    w = np.abs(signed)
    codes = items.codes(w)
    where = np.flatnonzero(codes >= 0)
    if not len(where):
        return []
    where = where[np.argsort(codes[where], kind="stable")]  # the suffix array, as far as it can match
    sorted_ = codes[where]
    low, high = np.searchsorted(sorted_, items.suffixes, "left"), np.searchsorted(sorted_, items.suffixes, "right")
    count = high - low
    if not count.sum():
        return []
    q = np.repeat(items.at, count)
    p = where[np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
    length = np.full(len(q), SEED)
    going = np.ones(len(q), bool)
    while going.any():  # the longest verbatim match from each location
        a, b = np.minimum(p + length, len(w) - 1), np.minimum(q + length, len(items.words) - 1)
        going &= (w[a] == items.words[b]) & (w[a] > 0)
        length += going
    doc, item = np.searchsorted(ends, p, "right") - 1, items.owner[q]
    order = np.lexsort((p, item, doc))
    doc, item, p, q, length = doc[order], item[order], p[order], q[order], length[order]
    edge = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])])
    n = np.diff(np.r_[edge, len(doc)])
    verbatim = np.maximum.reduceat(length, edge)
    found, tasks = [], []
    for e, k, longest in zip(edge, n, verbatim):
        if k < 3:
            continue
        # windows of the document where seeds are close together on nearby diagonals
        group = range(e, e + k)
        begin = last = None
        for g in (*group, None):
            if begin is None:
                begin = last = g
                continue
            if g is None or p[g] - p[last] > 20:
                if last - begin + 1 >= 3:
                    tasks.append((int(doc[e]), int(item[e]), int(longest), max(ends[doc[e]], int(p[begin]) - 24), min(ends[doc[e] + 1], int(p[last]) + SEED + 24)))
                begin = g
            last = g
    by_width: dict[int, list] = {}
    for t in tasks:
        by_width.setdefault(-(-(t[4] - t[3]) // 64), []).append(t)
    for width, group in by_width.items():
        for i in range(0, len(group), 500):
            part = group[i : i + 500]
            windows, sure = np.zeros((len(part), width * 64), np.int64), np.zeros((len(part), width * 64), bool)
            for r, (_, _, _, a, b) in enumerate(part):
                windows[r, : b - a], sure[r, : b - a] = w[a:b], signed[a:b] > 0
            score, span = align(items, np.array([t[1] for t in part]), windows, sure)
            found += [(t[1], t[0], t[2], float(s), int(k)) for t, s, k in zip(part, score, span)]
    return found


LEAST_SCORE = 12.1
#: Words by which a stretch may seem shorter because its first or last words are the altered ones.
EDGE = 2


def leaked(documents: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, least_words: int = LEAST_WORDS, least_score: float = LEAST_SCORE) -> DataFrame:
    """``item_id, doc_id, verbatim, score, span``: the documents that carry an item or a stretch of at least ``least_words`` of its words.

    ``verbatim`` is the longest run of words in common, ``span`` the item's words from the first to the last of the stretch.
    Whole texts are searched, every document once; null, empty and wordless texts and items carry and give nothing; repeated rows
    count once. Items are sent to the tasks in slices of bounded size; no document leaves its task.
    """
    sizes = items.select(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length(item_text)), F.lit(0)).alias("c")).first()
    slices = max(1, -(-int(sizes["c"]) // SLICE_CHARS))
    kind = {c: documents.select(doc_id).schema[0].dataType.simpleString() if c == doc_id else items.select(item_id).schema[0].dataType.simpleString() for c in (doc_id, item_id)}
    found = None
    for k in range(slices):
        own = items.select(F.col(item_id).alias("i"), F.col(item_text).alias("t")).where(F.col("t").isNotNull()).distinct()
        rows = [(r["i"], r["t"]) for r in own.where(F.pmod(F.xxhash64("i", "t"), F.lit(slices)) == k).orderBy("i", "t").collect()]

        def run(batches: Iterator[pa.RecordBatch], rows=rows) -> Iterator[pa.RecordBatch]:
            known = Items(rows)
            names = [r[0] for r in rows]
            for batch in batches:
                keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                at = 0
                while at < len(texts):
                    end, words = at, 0
                    while end < len(texts) and (end == at or words < SHARD_WORDS):
                        words += len(texts[end] or "") // 5
                        end += 1
                    hits = [(names[i], keys[at + d], v, s, n) for i, d, v, s, n in search_shard(known, texts[at:end]) if s >= least_score and n >= least_words - EDGE]
                    columns = [list(c) for c in zip(*hits)] or [[], [], [], [], []]
                    yield pa.record_batch([pa.array(columns[0], pa.int64() if kind[item_id] == "bigint" else None), pa.array(columns[1], pa.int64() if kind[doc_id] == "bigint" else None), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.float64()), pa.array(columns[4], pa.int32())], names=[item_id, doc_id, "verbatim", "score", "span"]) if hits else pa.RecordBatch.from_pylist([], schema=_schema(item_id, doc_id, kind))
                    at = end

        part = documents.select(doc_id, text).where(F.col(text).isNotNull()).mapInArrow(run, f"{item_id} {kind[item_id]}, {doc_id} {kind[doc_id]}, verbatim int, score double, span int")
        found = part if found is None else found.unionByName(part)
    return found.groupBy(item_id, doc_id).agg(F.max("verbatim").alias("verbatim"), F.max("score").alias("score"), F.max("span").alias("span"))


def _schema(item_id: str, doc_id: str, kind: dict[str, str]) -> pa.Schema:
    as_arrow = lambda k: {"bigint": pa.int64(), "int": pa.int32()}.get(k, pa.string())
    return pa.schema([(item_id, as_arrow(kind[item_id])), (doc_id, as_arrow(kind[doc_id])), ("verbatim", pa.int32()), ("score", pa.float64()), ("span", pa.int32())])


def without_leaks(documents: DataFrame, doc_id: str, found: DataFrame) -> DataFrame:
    """The documents that no item leaked into."""
    return documents.join(found.select(doc_id).distinct(), doc_id, "left_anti")
