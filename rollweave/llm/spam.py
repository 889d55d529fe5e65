"""Keyword-stuffed and link-list pages, found by the perplexity of their function-word and word-class sequences.

A word is itself if it is a function word, else its class: name or other word, and how often the page
repeats it; numbers, marks, links, tags, prices are classes too. A trigram model of these
sequences is trained on the prose, rolls, indexes and notes of all documents, and every segment of every page
is scored by it. A segment whose perplexity is abnormally high or low for such text is no content; a
page is flagged if they make up more than half of it. Nothing but the model's score flags.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollweave.session import cut

# fixed values: function words of the languages of the corpus
FUNCTION_WORDS = {
    "en": "a about after again all also an and another any are as at be been before being but by can could did do does down during each for from had has have he her here him his how i if in into is it its just me more most my no not of off on once one only or other our out over own she should so some such than that the their them then there these they this those through to too under until up very was we were what when where which while who whom whose why will with without would you your",
    "fr": "au aux avec ce ces dans de des du elle en est et eut fut il ils la le les leur lui mais ne nous on ou par pas pour qu que qui sa sans se ses son sur un une vers dont",
    "de": "aber als am an auf aus bei beim bis das dem den der des die ein eine einem einen einer er es für hat hatte ihn ihr im in ist mit nach nicht noch oder sein seine sich sie sind so über um und von vom vor war waren wie wird wurde zu zum zur",
    "es": "al ante con cuando de del desde donde el ella en entre era es esta este fue ha hasta la las le les lo los más no o para pero por que se según ser si sin sobre su sus un una y ya",
}
FUNCTION = {w: i for i, w in enumerate(sorted({w for words in FUNCTION_WORDS.values() for w in words.split()}))}
TOKEN = re.compile(
    r"(?P<link>https?://[^\s\x22\x27<>)\]]+|www\.[^\s\x22\x27<>)\]]+|\b[\w-]+\.[a-z]{2,}/[^\s\x22\x27<>)\]]*|\(/[^\s)]*\)|</?a\b[^<>]*>)"
    r"|(?P<skip></?[a-z][^<>]*>|&[a-z]+;|[\u200b-\u200f\u2060\ufeff\xad])"
    r"|(?P<tag>[#@]\w+)"
    r"|(?P<price>[$€£]\s?\d[\d.,]*|\b\d+[.,]\d\d\s?(?:€|usd|eur)\b)"
    r"|(?P<number>\d[\d.,:/-]*(?:st|nd|rd|th)?)"
    r"|(?P<word>[^\W\d_]+(?:['’][^\W\d_]+)*)"
    r"|(?P<arrow>>>|<<|»|«|→)"
    r"|(?P<mark>[^\w\s])",
    re.I,
)
END = re.compile(r"(?<=[.!?])\s+|\n+")
SHORT, LONG = 12, 40  # tokens of a segment: shorter ones are joined to the next, longer ones split
LISTED = 12  # tokens for each link, tag, price or list mark below which a page has many of them
LEVELS = (2, 3, 5, 9)  # times a page repeats a pair of words from which the pair is of the next class

# the classes, as numbers: function words, marks, others, list signs of pages with many of them, words, names
MARKS = {m: len(FUNCTION) + i for i, m in enumerate(".,;:!?()'\"-|*/[]&")}
OTHER, NUMBER, START, STOP, LINK, TAG, PRICE, ARROW = range(len(FUNCTION) + len(MARKS), len(FUNCTION) + len(MARKS) + 8)
SIGN = {"number": NUMBER, "link": LINK, "tag": TAG, "price": PRICE, "arrow": ARROW}
MANY = {c: ARROW + 1 + i for i, c in enumerate((LINK, TAG, PRICE, ARROW, MARKS["["], MARKS["|"], MARKS["*"]))}
WORD = ARROW + 1 + len(MANY)  # word of no, some, ... repetition
NAME = WORD + len(LEVELS) + 2
CLASSES = NAME + len(LEVELS) + 2
#: The class as what stands before a token: whether a page repeats it doesn't matter there, else stuffed pages predict themselves.
BEFORE = np.array([OTHER if ARROW < c < WORD else c if c < WORD else WORD if c < NAME else NAME for c in range(CLASSES)])


class _Pair:
    """How a page repeats a pair of neighbouring content words."""

    __slots__ = ("after", "bare", "n", "within")

    def __init__(self) -> None:
        self.n = self.bare = 0
        self.after: set[int] = set()
        self.within: set[int] = set()

    def close(self, after: int | None, piece: int) -> None:
        self.n += 1
        self.within.add(piece)
        if after is None:
            self.bare += 1
        else:
            self.after.add(after)

    def times(self) -> int:
        """Repetitions that count: all if mostly no function word follows the pair, else those before other function words or in other sentences."""
        return self.n if 2 * self.bare >= self.n else max(len(self.after), len(self.within))


def segments(text: str) -> list[tuple[list[int], float]]:
    """The page's segments: the classes of their tokens, and their characters."""
    seen: Counter = Counter()
    pairs: dict[tuple[str, str], _Pair] = {}
    pieces: list[tuple[list, int]] = []
    total = listing = 0
    for piece in END.split(text):
        out: list = []
        last = pair = None  # content word before, and the pair that it ends
        key = hash(piece)
        for m in TOKEN.finditer(piece):
            kind, token = m.lastgroup, m[0]
            if kind == "word":
                low = token.lower()
                code = FUNCTION.get(low)
                if pair is not None:
                    pair.close(code, key)
                    pair = None
                if code is not None:
                    out.append(code)
                    last = None
                    continue
                seen[low] += 1
                if last is not None:
                    pair = pairs.get((last, low))
                    if pair is None:
                        pair = pairs[last, low] = _Pair()
                out.append((last, low, NAME if token[0].isupper() else WORD))
                last = low
            elif kind == "mark" and token in "-'’":
                out.append(MARKS.get(token, OTHER))
            elif kind != "skip":
                if pair is not None:
                    pair.close(None, key)
                    pair = None
                last = None
                out.append(MARKS.get(token, OTHER) if kind == "mark" else SIGN[kind])
                listing += out[-1] in MANY
        if pair is not None:
            pair.close(None, key)
        total += len(out)
        pieces.append((out, len(piece)))
    times = {p: x.times() for p, x in pairs.items() if x.n > 1}
    many = MANY if listing * LISTED > total else {}
    found: list[tuple[list[int], float]] = []
    now: list[int] = []
    chars = 0
    for out, length in pieces:
        for i, x in enumerate(out):
            if type(x) is not tuple:
                now.append(many.get(x, x))
                continue
            last, low, kind = x
            n = times.get((last, low), 0)
            if i + 1 < len(out) and type(out[i + 1]) is tuple:
                n = max(n, times.get(out[i + 1][:2], 0))
            level = sum(n >= at for at in LEVELS)
            now.append(kind + (level + 1 if level else seen[low] > 1))
        chars += length
        if len(now) >= SHORT:
            found += [(now[i : i + LONG], chars * len(now[i : i + LONG]) / len(now)) for i in range(0, len(now), LONG)]
            now, chars = [], 0
    if now and found and len(now) < SHORT:
        part, length = found.pop()
        found.append((part + now, length + chars))
    elif now:
        found.append((now, float(chars)))
    return found


@dataclass(frozen=True)
class Sequences:
    """Class sequences of many segments, flat: ``codes`` with two starts and a stop each, ``lengths`` with these, ``chars``, ``page``."""

    codes: np.ndarray
    lengths: np.ndarray
    chars: np.ndarray
    page: np.ndarray

    @property
    def segment(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.lengths)), self.lengths)

    def prose(self) -> np.ndarray:
        """Which segments the model is trained on: those without list signs of a page that has many, and little repeated."""
        n = len(self.lengths)
        level = np.where(self.codes >= NAME, self.codes - NAME, self.codes - WORD)
        listed = np.bincount(self.segment, (self.codes > ARROW) & (self.codes < WORD), n)
        repeated = np.bincount(self.segment, level >= 3, n)
        return (listed == 0) & (repeated < REPEATED * (self.lengths - 3))

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Trigrams as numbers, and the segment of each."""
        x, segment = BEFORE[self.codes], self.segment
        grams = (x[:-2] * CLASSES + x[1:-1]) * CLASSES + self.codes[2:]
        inside = segment[:-2] == segment[2:]
        return grams[inside], segment[2:][inside]


REPEATED = 0.3  # share of words of much repeated pairs from which a segment is not trained on


def _encode(keys: list, texts: list[str | None]) -> pa.RecordBatch:
    codes, lengths, chars = [], [], []
    for text in texts:
        parts = segments(text) if text else []
        codes.append(np.array([c for part, _ in parts for c in (START, START, *part, STOP)], np.int16).tobytes())
        lengths.append(np.array([len(part) + 3 for part, _ in parts], np.int16).tobytes())
        chars.append(np.array([n for _, n in parts], np.float32).tobytes())
    return pa.record_batch([keys, pa.array(codes, pa.binary()), pa.array(lengths, pa.binary()), pa.array(chars, pa.binary())], names=["d", "codes", "lengths", "chars"])


def _decode(batch: pa.RecordBatch) -> Sequences:
    read = lambda name, kind: [np.frombuffer(b, kind) for b in batch.column(batch.schema.get_field_index(name)).to_pylist()]
    codes, lengths, chars = read("codes", np.int16), read("lengths", np.int16), read("chars", np.float32)
    join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
    return Sequences(join(codes, np.int64), join(lengths, np.int64), join(chars, float), np.repeat(np.arange(len(lengths)), [len(x) for x in lengths]))


def class_sequences(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``d, codes, lengths, chars``: the class sequences of each text's segments, as packed numbers. Texts are read once, here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _encode(batch.column(0), batch.column(1).to_pylist())

    kind = df.select(doc_id).schema[0].dataType.simpleString()
    rows = df.select(F.col(doc_id).alias("d"), F.col(text).alias("t")).where("t is not null")
    return rows.mapInArrow(run, f"d {kind}, codes binary, lengths binary, chars binary")


def trigrams(sequences: DataFrame) -> DataFrame:
    """``gram, n``: the class trigrams of all prose segments; as many rows as classes allow, whatever the data's size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = _decode(batch)
            grams, segment = s.grams()
            found, n = np.unique(grams[s.prose()[segment]], return_counts=True)
            yield pa.record_batch([pa.array(found, pa.int64()), pa.array(n, pa.int64())], names=["gram", "n"])

    return sequences.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


SHARE_KEPT = 1e-5  # of all tokens: rarer trigrams and contexts say nothing
WEIGHTS = (0.55, 0.3, 0.14, 1e-5)  # of trigram, bigram, class, and any


@dataclass(frozen=True)
class ClassModel:
    """A trigram model over classes with fixed weights, so that it is the same for any size of the same corpus."""

    grams: np.ndarray
    three: np.ndarray
    two: np.ndarray
    one: np.ndarray
    known: np.ndarray

    @classmethod
    def of(cls, counts: DataFrame) -> ClassModel:
        """The model of ``trigrams``. At most ``1 / SHARE_KEPT`` trigrams and the square of the classes in bigrams reach the driver."""
        total = counts.agg(F.sum("n")).first()[0] or 0
        grams = counts.where(F.col("n") >= SHARE_KEPT * total).collect()
        ends = counts.groupBy((F.col("gram") % (CLASSES * CLASSES)).alias("gram")).agg(F.sum("n").alias("n")).collect()
        contexts = counts.groupBy(F.floor(F.col("gram") / CLASSES).cast("long").alias("gram")).agg(F.sum("n").alias("n")).collect()
        table = lambda rows: (np.array([r["gram"] for r in rows], np.int64), np.array([r["n"] for r in rows], float))
        fill = lambda rows: np.bincount(*table(rows), CLASSES * CLASSES) if rows else np.zeros(CLASSES * CLASSES)
        pairs, before = fill(ends).reshape(CLASSES, CLASSES), fill(contexts)
        one = pairs.sum(0) / max(total, 1)
        after = pairs.sum(1, keepdims=True)
        two = np.where(after > SHARE_KEPT * total, pairs / np.maximum(after, 1), one[None])
        key, n = table(sorted(grams, key=lambda r: r["gram"]))
        return cls(key, n / before[key // CLASSES] if len(key) else n, two, one, before > SHARE_KEPT * total)

    def bits(self, s: Sequences) -> np.ndarray:
        """Mean bits of a token of each segment, given the two before it."""
        grams, segment = s.grams()
        a, c = grams // CLASSES, grams % CLASSES
        two = self.two[a % CLASSES, c]
        three = np.zeros(len(grams))
        if len(self.grams):
            at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
            three = np.where(self.grams[at] == grams, self.three[at], 0.0)
        three = np.where(self.known[a], three, two)
        cost = -np.log2(WEIGHTS[0] * three + WEIGHTS[1] * two + WEIGHTS[2] * self.one[c] + WEIGHTS[3])
        return np.bincount(segment, cost, len(s.lengths)) / np.maximum(s.lengths - 2, 1)


def usual_bits(sequences: DataFrame, model: ClassModel) -> tuple[float, float]:
    """Mean and standard deviation of the bits of all prose segments; one row reaches the driver."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = _decode(batch)
            b = model.bits(s)[s.prose()]
            yield pa.record_batch([pa.array([len(b)], pa.int64()), pa.array([float(b.sum())]), pa.array([float((b * b).sum())])], names=["n", "s", "q"])

    n, s, q = sequences.mapInArrow(measure, "n long, s double, q double").agg(F.sum("n"), F.sum("s"), F.sum("q")).first()
    return (s / n, max(q / n - (s / n) ** 2, 0.0) ** 0.5) if n else (0.0, float("inf"))


SHARE = 0.5  # of the page's characters
ABNORMAL = 4.5  # standard deviations of prose from its mean bits, up or down, from which a segment is none


def page_shares(model: ClassModel, s: Sequences, usual: tuple[float, float], pages: int, abnormal: float = ABNORMAL) -> np.ndarray:
    """The share of each page's characters in segments of abnormally high or low perplexity; 0 for pages without tokens."""
    odd = (np.abs(model.bits(s) - usual[0]) > abnormal * usual[1]) & (s.lengths - 3 >= SHORT)
    total = np.bincount(s.page, s.chars, pages)
    return np.bincount(s.page, s.chars * odd, pages) / np.where(total > 0, total, 1)


def stuffed_pages(df: DataFrame, doc_id: str, text: str, share: float = SHARE, model_of: DataFrame | None = None) -> DataFrame:
    """``doc_id, share`` of the pages of which more than ``share`` is repeated keywords, tags, prices or links.

    The model is trained on all rows of ``model_of`` (``df`` if not given). Whole texts are scored. Null, empty and
    blank texts, and those of fewer than ``SHORT`` tokens, which are too few to judge, are never flagged; repeated rows are scored alike and count once; an empty table flags nothing. The class
    sequences, a fraction of the text, are written once and read by each step.
    """
    pages = cut(class_sequences(df, doc_id, text))
    known = pages if model_of is None else cut(class_sequences(model_of, doc_id, text))
    model = ClassModel.of(cut(trigrams(known)))
    usual = usual_bits(known, model)
    kind = df.select(doc_id).schema[0].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = page_shares(model, _decode(batch), usual, batch.num_rows)
            kept = np.flatnonzero(found > share)
            yield pa.record_batch([batch.column(0).take(pa.array(kept)), pa.array(found[kept])], names=[doc_id, "share"])

    return pages.mapInArrow(score, f"`{doc_id}` {kind}, share double").groupBy(doc_id).agg(F.max("share").alias("share"))
