"""Leaks and stuffed pages on small corpora."""

import random

import numpy as np
import pyarrow as pa

from rollweave.llm.leakage import leaked, without_leaks
from rollweave.llm import spam
from rollweave.llm.spam import NAME, WORD, segments, stuffed_pages

WORDS = [f"{a}{b}" for a in ("bri", "cal", "dor", "fen", "gal", "hul", "mer", "nor", "pel", "tam") for b in ("ander", "ton", "ley", "wick", "ing", "ora", "est", "ulm", "ock", "ave")]


def test_leaks(spark):
    rng = random.Random(9)
    text = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    items = [(i, text(60).capitalize() + ".", "test") for i in range(12)]
    words = [t[:-1].lower().split() for _, t, _ in items]
    docs, want = [], set()

    def doc(body, *found):
        docs.append((len(docs), body, "clash"))
        want.update((i, len(docs) - 1) for i in found)

    for _ in range(150):
        doc(text(rng.randrange(200)))
    doc(text(40) + " " + " ".join(words[0]) + " " + text(40), 0)  # whole
    doc(text(30) + " " + " ".join(words[1][10:27]).upper() + "! " + text(30), 1)  # a stretch
    altered = list(words[2][5:40])
    altered[7], altered[20] = "with", altered[20][:-1] + "x"
    doc(text(10) + " " + ", ".join(altered) + " " + text(10), 2)  # lightly altered
    doc(text(30) + " " + " ".join(words[3][10:19]) + " " + text(30))  # too short
    doc(" ".join(words[4]) + " " + " ".join(words[5][:20]), 4, 5)
    doc(text(30_000) + " " + " ".join(words[6][:30]), 6)  # a very long text
    docs += [(900, None, ""), (901, "", ""), (902, "...", ""), docs[150]]
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    it = spark.createDataFrame(items + [(70, None, ""), (71, "", ""), items[0]], "item_id long, text string, split string")
    found = leaked(df.drop("item_id"), "doc_id", "text", it, "item_id", "text")
    assert {(r["item_id"], r["doc_id"]) for r in found.collect()} == want
    assert without_leaks(df.select("doc_id").distinct(), "doc_id", found).count() == len({d[0] for d in docs}) - len({d for _, d in want})
    assert leaked(df.drop("item_id").limit(0), "doc_id", "text", it, "item_id", "text").collect() == [] and leaked(df.drop("item_id"), "doc_id", "text", it.limit(0), "item_id", "text").collect() == []


def test_pages(spark):
    rng = random.Random(3)
    prose = lambda n: " ".join(f"The {rng.choice(WORDS)} of the {rng.choice(WORDS)} was seen by {rng.choice(WORDS).title()} in {1850 + rng.randrange(60)}, and his {rng.choice(WORDS)} was kept at the {rng.choice(WORDS)}." for _ in range(n))
    roll = lambda n: "\n".join(f"{rng.choice(WORDS).title()}, {rng.choice(WORDS).title()} {rng.choice('ABC')}., Pvt, enl. {1 + rng.randrange(28)} May {1861 + rng.randrange(4)}" for _ in range(n))
    names = lambda n: "Surnames: " + ", ".join(rng.choice(WORDS).title() for _ in range(n))
    keys = lambda n: ", ".join(rng.choice(["grave finder", "pension records", "free genealogy"]) for _ in range(n))
    links = lambda n: "\n".join(f"* [{rng.choice(WORDS)} {rng.choice(WORDS)}](https://{rng.choice(WORDS)}.example/{rng.randrange(999)})" for _ in range(n))
    tags = lambda n: " ".join(f"#{rng.choice(WORDS)}{rng.randrange(9)}" for _ in range(n))
    prices = lambda n: "\n".join(f"{rng.choice(WORDS)} {rng.choice(WORDS)} ${rng.randrange(90)}.{10 + rng.randrange(89)}" for _ in range(n))
    poem = lambda: "".join(f"\nThe {rng.choice(WORDS)} {rng.choice(WORDS)} a {rng.choice(WORDS)} by the {rng.choice(WORDS)},\n{refrain}" for refrain in [f"O {rng.choice(WORDS)} gin, O {rng.choice(WORDS)} road."] for _ in range(8))
    good = [poem() for _ in range(12)] + [prose(rng.randrange(3, 12)) for _ in range(120)] + [prose(2) + "\n" + roll(15) for _ in range(12)] + [prose(1) + "\n" + names(40) for _ in range(12)] + [prose(8) + "\n" + keys(8), prose(6) + " #tag https://a.example/1"]
    bad = [f(40) for f in (keys, links, tags, prices) for _ in range(3)] + [prose(1) + "\n" + keys(60), links(30) + "\n" + prose(1)]
    rows = list(enumerate(good + bad)) + [(900, None), (901, ""), (902, " \n "), (903, "?"), (904, "a" * 200_000), (132, good[132])]
    df = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, share double").drop("share")
    got = {r["doc_id"] for r in stuffed_pages(df, "doc_id", "text").collect()}
    assert got == set(range(len(good), len(good) + len(bad)))
    assert stuffed_pages(df.limit(0), "doc_id", "text").collect() == [] and segments("") == []
    # the model decides: with a constant in its place nothing is found
    class Flat:
        bits = staticmethod(lambda s: np.full(len(s.lengths), 5.0))

    texts = [t for _, t in rows]
    s = spam._decode(spam._encode(pa.array(range(len(texts))), texts))
    assert spam.page_shares(Flat(), s, (5.0, 0.0), len(texts)).max() == 0.0


def test_classes():
    keys = ", ".join(["grave finder", "pension records"] * 9)
    assert all(c < WORD or (c - WORD) % (NAME - WORD) == 5 for part, _ in segments(keys) for c in part)
    once = "He saw the handsome stone, and the gin by the careful road was sold to Harlan."
    assert all(c < WORD or (c - WORD) % (NAME - WORD) == 0 for part, _ in segments(once) for c in part)
