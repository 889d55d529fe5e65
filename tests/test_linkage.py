"""Blocking, verdicts, components and merges against plain Python."""

import random

from pyspark.sql import functions as F

from rollweave.functions.phonetic import metaphone_word, nysiis_word
from rollweave.operators import blocking, linkage, merge
from rollweave.operators.components import components


def one(spark, expr, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(expr.alias("y")).first()["y"]


def test_codes_of_known_names():
    assert nysiis_word("Looney") == "LANY" and nysiis_word("William") == nysiis_word("Williams") == "WALAN"
    assert metaphone_word("Looney") == metaphone_word("Loney") == "LN" and metaphone_word("William") == "WLM" != metaphone_word("Williams")
    assert metaphone_word("John") == metaphone_word("Jon")


def test_block_lookup(spark):
    vets = [(1, "William Looney"), (2, "Wm Loney"), (3, "Peter Smith"), (4, "William"), (None, "Ann Looney"), (5, ""), (6, None), (1, "William Looney")]
    index = blocking.block_index(spark.createDataFrame(vets, "id long, name string"), "id", "name")
    keys = {(r["block_key"], r["id"]) for r in index.collect()}
    assert {("surname_metaphone:LN", 1), ("surname_nysiis:LANY", 1), ("surname_prefix:lo", 2), ("firstname_metaphone:WLM", 4)} <= keys
    asked = spark.createDataFrame([(9, "William", "Looney"), (8, "", ""), (7, None, "Smythe")], "q long, f string, l string")
    got = {(r["q"], r["id"]) for r in blocking.block_lookup(asked, "q", "f", "l", index, "id").collect()}
    assert {(9, 1), (9, 2), (9, 4)} <= got and not any(q == 8 for q, _ in got) and (7, 3) in got
    assert blocking.block_lookup(asked, "q", "f", "l", index, "id", 2).where("q = 9").count() == 2


def test_verdicts(spark):
    score = lambda a, b, c=True, d=True: one(spark, linkage.strength_bucket(F.lit(a), F.lit(b), F.lit(c), F.lit(d)), x="")
    assert [score(0.7, 1.0), score(0.96, 0.1), score(0.85, 0.2), score(0.96, 0.0, True, False), score(0.85, 0.0, True, False), score(1.0, 1.0, False)] == ["none", "strong", "medium", "medium", "weak", "none"]
    assert one(spark, linkage.year_bucket("a", "b"), a="1840", b="May 1842") == "close" and one(spark, linkage.year_bucket("a", "b"), a="", b="1842") == "unknown"
    assert one(spark, linkage.units_agree("a", "b"), a="34 TX", b="4th TX Cav") is True and one(spark, linkage.units_agree("a", "b"), a="34th", b="4 TX") is None
    v = lambda s, ua, ub, ya, yb: one(spark, linkage.registry_verdict(F.lit(s), "a", "b", "c", "d"), a=ua, b=ub, c=ya, d=yb)
    assert [v("strong", "1 TX", "1 AL", "1800", "1850"), v("strong", "1 TX", "1 AL", "1840", "1840"), v("weak", "", "", "1840", "1841"), v("none", "", "", "1840", "1840"), v("strong", "", "", "", "")] == ["weak", "medium", "strong", "none", "medium"]
    d = lambda *x: one(spark, linkage.duplicate_strength(*"abcdefgh"), **dict(zip("abcdefgh", x)))
    assert d("Lee", "Jo", "4 LA", "1840", "lee ", "JO", "x", "1842") == "strong" and d("Lee", "Jo", "", "x", "Lee", "Joe", "", "") == "weak" and d("Lee", "Jo", "", "", "Lee", "Jo", "", "") == "medium" and d("", "", "", "", "", "", "", "") == "none"
    s = lambda b, st, r=False: one(spark, linkage.duplicate_status(F.lit(b), "a", F.lit(r)), a=st)
    assert [s("strong", "auto_accept"), s("medium", "x"), s("weak", ""), s("none", "no_results"), s("none", "low_score"), s("none", "", True)] == ["duplicate", "follow_up_candidate", "clear", "no_fag_match", "clear", "clear"]


def test_corroboration(spark):
    c = lambda da, db, sa, sb, m=True: one(spark, linkage.corroboration(F.lit(m), "a", "b", "c", "d"), a=da, b=db, c=sa, d=sb)
    assert [c("1932-02-28", "1931", "OK", "ok"), c("1932", "1932", "OK", "TX"), c("", "", "OK", "OK"), c("1932", "", "", ""), c("1932", "1900", "OK", "OK"), c("", "", "", ""), c("1932", "1932", "", "", False)] == [0.95, 0.80, 0.70, 0.60, None, None, None]
    m = lambda *x: one(spark, linkage.soft_name_match(*"abcd"), **dict(zip("abcd", x)))
    assert m("William", "Looney", "W.", "Loonie") and not m("William", "Looney", "Ann", "Looney") and not m("W", "", "W", "")
    pairs = spark.createDataFrame([(1, 0, 1, 0.6), (1, 0, 0, None), (1, 1, 0, 0.95), (2, 0, 0, None)], "k long, a int, b int, c double")
    assert [tuple(r) for r in linkage.first_corroborated(pairs, "k", "a", "b", "c").collect()] == [(1, 0, 1, 0.6)]


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(80)] + [(200 + i, 201 + i) for i in range(60)] + [(None, 1), (5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_same_person(spark):
    rows = [(1, "John", "Müller", "1840", "", 1, "", ""), (2, "Jon", "Muller", "1842-01-01", "", 2, "", ""), (3, "John", "Muller", "1900", "", 3, "", ""), (4, "", "Muller", "1840", "", 1, "", ""), (5, "Zed", "Muller", "1840", "", 1, "", ""), (6, "John", "Muller", None, None, 3, None, None)]
    reg = spark.createDataFrame(rows, "id long, f string, l string, b string, d string, c long, u string, r string")
    edges = linkage.same_person_edges(reg, "id", "f", "l", "b", "d", "c", "u", "r")
    assert {tuple(x) for x in edges.collect()} == {(1, 2), (3, 6)}
    persons = {r["id"]: (r["person_id"], r["size"]) for r in linkage.canonical_persons(reg, "id", edges).collect()}
    assert persons[2] == ("person_1", 2) and persons[6] == ("person_3", 2) and persons[5] == ("person_5", 1)


def test_spouse_and_tiers(spark):
    s = lambda *x, strict=False: one(spark, linkage.spouse_strength(*"abcd", strict=strict), **dict(zip("abcd", x)))
    assert [s("Ann", "Lee", "ann.", "LEE"), s("Ann", "Lee", "Eve", "Lee"), s("Ann", "Lee", "Eve", "Lee", strict=True), s("", "Lee", "Ann", "Lee"), s("Ann", "Lee", "Ann", "Poe")] == ["strong", "medium", None, None, None]
    left = spark.createDataFrame([(1, "A1", "x", ""), (2, "", "x", "kept"), (3, None, "zz", None)], "i long, k1 string, k2 string, v string")
    right = spark.createDataFrame([("A1", "q", "one", 1), ("A1", "q", "last", 2), ("", "x", "two", 3)], "r1 string, r2 string, w string, o int")
    got = {r["i"]: (r["v"], r["tier"]) for r in linkage.tiered_join(left, right, [("k1", "r1"), ("k2", "r2")], {"v": "w"}, "o").collect()}
    assert got == {1: ("last", 0), 2: ("kept", 1), 3: ("", None)}


def test_merges(spark):
    rows = spark.createDataFrame([("m", "B1", 1, 0.4, "a"), ("m", "B4", 2, 0.9, "b"), ("m", "B1", 3, 0.9, "c"), ("n", "B4", 4, None, "d")], "id string, s string, pos int, score double, x string")
    first = {r["id"]: (r["x"], list(r["via_strategies"])) for r in merge.merge_first(rows, ["id"], ["pos"], "s", ["x"]).collect()}
    assert first == {"m": ("a", ["B1", "B4"]), "n": ("d", ["B4"])}
    best = {r["id"]: (r["score"], r["x"]) for r in merge.merge_best(rows, ["id"], "score", ["pos"], ["x"]).collect()}
    assert best == {"m": (0.9, "b"), "n": (0.0, "d")}
    assert [(r["x"], r["rank"]) for r in merge.top_per_key(rows, "id", "score", ["pos"], 2).where("id = 'm'").orderBy("rank").collect()] == [("b", 1), ("c", 2)]
    old = spark.createDataFrame([(1, "a", None), (2, "b", 1)], "k long, s string, n int")
    new = spark.createDataFrame([(1, "a", 2), (3, "c", 1)], "k long, s string, n int")
    assert {tuple([r["k"], r["side"], tuple(r["changed"])]) for r in merge.compare_runs(old, new, "k", ["s", "n"]).collect()} == {(1, "both", ("n",)), (2, "old", ()), (3, "new", ())}
