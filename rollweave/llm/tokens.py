"""Encoding a corpus with a public byte-level BPE tokenizer, by prefix-sharing trie traversal.

Every prefix of a word has exactly one last token, and that token depends only on the last tokens of
shorter prefixes. So the distinct words of a batch go into a trie; one depth-first walk carries the
last tokens down, and what words share at their beginning is encoded once. No merge loop runs.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHED_WORDS = 400_000  # words a Python worker remembers before it starts anew


class PrefixBpe:
    """A byte-level BPE vocabulary with, per token, the two tokens it was merged from."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        # byte-level vocabularies write bytes as printable characters: those that print stand for themselves, the rest follow from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        vocabulary = model["vocab"]
        self.size = {i: len(t) for t, i in vocabulary.items()}
        self.parts: dict[int, tuple[int, int]] = {i: (i, i) for i in vocabulary.values()}
        self.merged: dict[tuple[int, int], int] = {}
        self.rank: dict[int, int] = {}
        for order, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            if left + right in vocabulary:
                a, b, c = vocabulary[left], vocabulary[right], vocabulary[left + right]
                self.merged[a, b] = order
                if c not in self.rank:
                    self.parts[c], self.rank[c] = (a, b), order
        self.tokens: dict = {}  # trie of the vocabulary: byte -> (below, token or -1)
        for t, i in vocabulary.items():
            if all(ch in shown for ch in t):
                node = self.tokens
                for ch in t[:-1]:
                    node = node.setdefault(shown[ch], [{}, -1])[0]
                node.setdefault(shown[t[-1]], [{}, -1])[1] = i
        self.pairs: dict[int, bool] = {}

    def stays(self, left: int, right: int) -> bool:
        """Whether the tokens stay apart when their bytes are encoded together."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            known = self.pairs[key] = self._stays(left, right)
        return known

    def _stays(self, a: int, b: int) -> bool:
        # undo merges from the latest back; the two sides must never offer a merge earlier than the one undone
        limit, rank, parts = 1 << 60, self.rank, self.parts
        while True:
            joined = self.merged.get((a, b))
            if joined is not None and joined < limit:
                return False
            ra, rb = rank.get(a, -1), rank.get(b, -1)
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a = ra, parts[a][1]
            else:
                # on the right side a merge of the same rank further left comes first
                limit, b = rb + 1, parts[b][0]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """The token ids of each word, by one depth-first walk over the trie of the words."""
        trie: dict = {}
        for at, word in enumerate(words):
            node = trie
            for byte in word:
                below = node.get(byte)
                if below is None:
                    below = node[byte] = {}
                node = below
            node.setdefault(-1, []).append(at)
        found: list[list[int]] = [[] for _ in words]
        last: list[int] = []  # last[d]: the last token of the prefix of d + 1 bytes on the current path
        size, stays = self.size, self.stays
        todo = [(1, byte, node, ()) for byte, node in trie.items() if byte != -1]
        while todo:
            depth, byte, node, open_ = todo.pop()
            del last[depth - 1 :]
            reaching = []  # tokens begun at some place of the path that go on, the longest first
            token = -1
            for start, below in (*open_, (depth - 1, self.tokens)):
                step = below.get(byte)
                if step is not None:
                    if step[0]:
                        reaching.append((start, step[0]))
                    if token < 0 and step[1] >= 0 and (start == 0 or stays(last[start - 1], step[1])):
                        token = step[1]
            last.append(token)
            reaching = tuple(reaching)
            for b, below in node.items():
                if b != -1:
                    todo.append((depth + 1, b, below, reaching))
            for at in node.get(-1, ()):
                ids, d = [], depth
                while d > 0:
                    ids.append(last[d - 1])
                    d -= size[last[d - 1]]
                found[at] = ids[::-1]
        return found


@lru_cache(maxsize=2)
def _loaded(path: str, pattern: str) -> tuple[PrefixBpe, regex.Pattern, dict[str, list[int]]]:
    return PrefixBpe(path), regex.compile(pattern), {}


def public_pattern() -> str:
    """The word pattern of the public byte-level tokenizers, with white space as Unicode defines it."""
    import public_tokenizers

    return public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


def public_path(name: str = "byte_bpe_50k.json") -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def encode_texts(texts: list[str | None], path: str, pattern: str) -> list[list[int]]:
    """The ids of each text; null and empty texts give an empty list."""
    bpe, words_of, known = _loaded(path, pattern)
    if len(known) > CACHED_WORDS:
        known.clear()
        bpe.pairs.clear()
    split = [words_of.findall(t) if t else [] for t in texts]
    new = list(dict.fromkeys(w for words in split for w in words if w not in known))
    for w, ids in zip(new, bpe.encode_words([w.encode("utf-8", "surrogatepass") for w in new])):
        known[w] = ids
    out = []
    for words in split:
        ids: list[int] = []
        for w in words:
            ids += known[w]
        out.append(ids)
    return out


def encode_corpus(df: DataFrame, key: str, text: str, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``key`` and ``ids``: the whole text of every row as token ids, without special tokens.

    Null and empty texts have an empty list; a text that spells a special token is ordinary text;
    rows are neither dropped nor merged, so repeated rows stay. Other columns are not read. Each task
    reads its rows once; nothing is shuffled, collected or broadcast, and a worker's memory is bounded by
    ``CACHED_WORDS`` and one Arrow batch.
    """
    path, pattern = path or public_path(), pattern or public_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                ids = encode_texts(part.column(1).to_pylist(), path, pattern)
                ends = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) for x in ids], out=ends[1:])
                flat = np.fromiter((i for x in ids for i in x), np.int32, int(ends[-1]))
                yield pa.record_batch([part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=[key, "ids"])

    kind = df.select(key).schema[0].dataType.simpleString()
    return df.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, ids array<int>")
