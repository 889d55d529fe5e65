"""Survivors by preference, and fusion with a copying source."""

import random

from pyspark.sql import functions as F

from rollweave.llm.fusion import birth_precision, fuse, known, survive


def test_known_and_precision(spark):
    v = ["1 April 1840", "Apr 1, 1840", "1840-04-01", "4/1/1840", "April 1840", "1840-04", "1840", "abt 1840", "1840?", "c. 1840", "c1840", "1816/17", "0000", "", None, "unknown"]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(v)], "i int, x string").orderBy("i").select(birth_precision(F.col("x"))).collect()]
    assert got == [4, 4, 4, 4, 3, 3, 2, 1, 1, 1, 1, 1, 0, 0, 0, 0]
    k = spark.createDataFrame([(x,) for x in ["n/a", " ? ", "Unknown", "", None, "-", "x1"]], "x string").select(known(F.col("x")))
    assert [r[0] for r in k.collect()] == [False] * 6 + [True]


def test_survive(spark):
    rows = [(1, "a", 1, 5), (1, "b", 2, 1), (1, "?", 9, 9), (2, None, 1, 1), (3, "x", 1, 1), (3, "y", 1, 1), (None, "z", 1, 1), (3, "y", 1, 1)]
    df = spark.createDataFrame(rows, "g long, v string, p int, q int")
    fields = {"v": ("v", known(F.col("v")), [F.col("p"), F.col("q")]), "w": ("v", known(F.col("v")), [F.col("q")])}
    assert {tuple(r) for r in survive(df, "g", fields).collect()} == {(1, "b", "a"), (2, None, None), (3, "y", "y")}
    assert survive(df.limit(0), "g", fields).collect() == []
    assert [r["g"] for r in survive(df, "g", fields, several="q").collect()] == [1]


def test_fuse(spark):
    rng = random.Random(7)
    rows = []
    for g in range(150):  # three fair sources, one poor one, and two that copy the poor one
        poor = "true" if rng.random() < 0.3 else f"wrong{rng.randrange(3)}"
        rows += [(g, "true" if rng.random() < 0.85 else f"odd{i}{rng.randrange(50)}", f"s{i}") for i in range(3)] + [(g, poor, "poor"), (g, poor, "copy1"), (g, poor, "copy2")]
    rows += [(None, "x", "s0"), (0, None, "s1"), (0, "?", "s2"), (500, "lone", None), rows[0]]
    df = spark.createDataFrame(rows, "g long, v string, s string")
    got = {r["g"]: (r["value"], r["posterior"]) for r in fuse(df, "g", ["v"], "s").collect()}
    right = sum(got[g][0] == "true" for g in range(150))
    majority = 0
    for g in range(150):
        votes = [v for x, v, _ in rows[:900] if x == g]
        majority += max(sorted(set(votes)), key=votes.count) == "true"
    assert right > majority and right >= 125
    assert got[500][0] == "lone" and all(0 <= p <= 1.000001 for _, p in got.values()) and set(got) == {*range(150), 500}
    assert fuse(df.limit(0), "g", ["v"], "s").collect() == []
