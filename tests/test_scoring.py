"""Scores and decisions."""

import pytest
from pyspark.sql import functions as F

from rollweave.operators import scoring
from rollweave.plans import ladder, regional


def score(spark, first, middle, last, state, death, slug, fstate, vet, birth, fdeath):
    df = spark.createDataFrame([(first, middle, last, state, death, slug, fstate, vet, birth, fdeath)], "f string, m string, l string, s string, d string, slug string, fs string, v boolean, b string, fd string")
    out = scoring.with_features(df, "x", {"first": "f", "middle": "m", "last": "l", "state": "s", "death": "d"}, {"slug": "slug", "state": "fs", "veteran": "v", "birth": "b", "death": "fd"})
    return round(out.select(scoring.weighted_score("x").alias("y")).first()["y"], 6)


def test_candidate_score(spark):
    # names, veteran, home and death agree: the largest score there is, with the state it can't be more
    assert score(spark, "John", "Q", "Lee", "TX", "1920", "john-q-lee", "OK", True, "1840", "1920") == pytest.approx(0.22 + 0.17 + 0.11 + 0.03 + 0.144 + 0.11)
    assert score(spark, "John", "", "Lee", "", "", "j-leeds", None, None, "", "") == pytest.approx(0.22 * 0.7 + 0.17 * 0.6 + 0.11 * 0.5)
    assert score(spark, "John", "Q", "Lee", "OK", "1920", "john-q-lee", "OK", True, "1990", "2020") == 0.0
    assert score(spark, "", "", "", "", "", "x", "", False, None, None) == pytest.approx(0.22 + 0.11 * 0.5)


def test_decide(spark):
    rows = [(1, 0.75, "1920"), (2, 0.75, "1920"), (2, 0.70, "1920"), (3, 0.62, ""), (4, 0.62, "1920"), (5, 0.3, None), (6, None, None), (7, 0.8, "0"), (7, 0.8, "0"), (8, 0.9, "1900"), (8, 0.5, "1900"), (8, 0.4, "1900")]
    d = {r["k"]: (r["status"], r["candidates"], round(r["gap"], 3)) for r in scoring.decide(spark.createDataFrame(rows, "k long, s double, d string"), "k", "s", "d").collect()}
    assert d == {1: ("auto_accept", 1, 0.75), 2: ("needs_review", 2, 0.05), 3: ("auto_accept", 1, 0.62), 4: ("needs_review", 1, 0.62), 5: ("low_score", 1, 0.3), 6: ("no_candidates", 0, 0.0), 7: ("needs_review", 2, 0.0), 8: ("auto_accept", 3, 0.4)}


def test_windows_and_buckets(spark):
    df = spark.createDataFrame([("1809", ""), ("1810", "1955"), (None, None), ("", "1956")], "b string, d string")
    assert [r[0] for r in df.select(scoring.in_window("b", "d")).collect()] == [False, True, True, False]
    s = spark.createDataFrame([(None,), (0.2,), (0.4,), (0.79,), (0.95,)], "s double")
    assert [r[0] for r in s.select(scoring.score_bucket("s")).collect()] == ["<0.20", "0.20-0.40", "0.40-0.60", "0.60-0.80", ">=0.95"]
    assert [r[0] for r in s.select(scoring.is_outlier(F.lit("ok"), "s")).collect()] == [True, True, False, False, False]
    n = spark.createDataFrame([("John", "Lee", "OK", "1840", "1900", "Col. Lee dies", "Tulsa, OK", "1905-01-01"), ("", "", "", "", "", None, None, None)], "f string, l string, s string, b string, d string, t string, p string, i string")
    assert [round(r[0], 3) for r in n.select(scoring.notice_score("f", "l", "s", "b", "d", "t", "p", "i")).collect()] == [0.8, 0.0]


def people(spark, *rows):
    df = spark.createDataFrame(list(rows), "i long, f string, m string, l string, b string, d string, r string, sp string")
    return df, ladder.person("f", "m", "l", "b", "d", regiment="r", spouse_last_name="sp")


def test_ladder(spark):
    df, p = people(spark, (1, "Mollie", "Q", "O'Hara", "1840", "1920", "2nd Texas Infantry", ""), (2, None, None, None, None, None, None, None), (3, "Al", "", "Lee", "0", "", "", "Poe"))
    got = {}
    for r in ladder.run_ladder(df, "i", p).collect():
        got.setdefault(r["i"], {})[r["strategy"]] = r["params"]
    assert set(got) == {1, 3} and set(got[1]) == set(ladder.LADDER)
    assert got[1]["B5-apostrophe"]["lastname"] == "OHara" and got[1]["F2-regiment-bio"]["bio"] == "2nd Texas" and got[1]["F3-nickname"]["firstname"] == "Mamie"
    assert got[1]["F1b-death-year"]["deathyearfilter"] == "10" and got[1]["F4-follow-up"] == {"lastname": "O'Hara", "fuzzy": "true", "birthyear": "1830", "birthyear_range": "20", "deathyear": "1910", "deathyear_range": "20"}
    assert got[3]["F3-nickname"]["lastname"] == "Poe" and got[3]["B1-exact"] == {"firstname": "Al", "lastname": "Lee", "exactspelling": "true"}
    assert [r["strategy"] for r in ladder.run_ladder(df, "i", p, mode="first").collect()] == ["B1-exact", "B1-exact"]


def test_templates_and_filters(spark):
    df, p = people(spark, (1, "Ann", "", "Lee", "7", "", "x", ""))
    spec = {"applies_when": ["last"], "params": {"q": "{first} {last}!", "m?": "{middle}", "r": {"transform": "replace", "input": "{last}", "args": ["e", "i"]}, "s": {"transform": "slice", "input": "{last}", "args": [-2, None]}, "n": {"transform": "format", "input": "{birth_year}", "args": [3]}, "u": {"transform": "upper", "input": "{extra.regiment}"}, "c": {"transform": "choice", "args": [{"when": {"regiment": "y"}, "then": 1}, {"when": {"regiment": "x"}, "then": 2}]}, "v": {"value": 5}, "gone": None, "odd": {}}}
    got = df.select(ladder.compile_template(spec)(p).alias("m")).first()["m"]
    assert got == {"q": "Ann Lee!", "r": "Lii", "s": "ee", "n": "007", "u": "X", "c": "2", "v": "5"}
    assert df.select(ladder.compile_template({"applies_when": ["middle"], "params": {"a": "b"}})(p).alias("m")).first()["m"] is None
    with pytest.raises(ValueError):
        ladder.compile_template({"params": {"a": {"transform": "nope"}}})(p)
    base = ladder.params(F.lit(True), firstname="J*", lastname="x~ y")
    f = ladder.with_filters(base, F.lit(""), {"location": "US"}, (F.lit("Eve"), F.lit(""), F.lit("Poe")))
    assert df.select(ladder.query_string(f).alias("q")).first()["q"] == "birthyear=1810&birthyearfilter=after&deathyear=1955&deathyearfilter=before&firstname=J%2A&lastname=x~+y&linkedToName=Eve+Poe&location=US"
    reg = ladder.StrategyRegistry()
    reg.register("mine", {"params": {"a": "{last}"}})
    assert "mine" in reg.names() and list(reg.ladder("mine")) == ["mine"]
    with pytest.raises(KeyError):
        reg.get("none")


def test_plans(spark):
    df = spark.createDataFrame([(1, "Lee", "4th Texas", "moved", 0.2, "x"), (2, "", "Ohio", "", 0.5, ""), (3, "Poe", "1st Georgia", "", 0.5, "needs_review"), (4, "Fry", "", "", 0.9, "")], "i long, l string, r string, n string, s double, st string")
    done = spark.createDataFrame([(1, "B1-exact", "TX")], "i long, strategy string, state string")
    got = {(r["i"], r["state"]) for r in regional.regional_plans(df, "i", "l", "r", F.lit(""), "r", done).collect()}
    assert got == {(1, "OK"), (1, "US"), (3, "OK"), (3, "GA"), (3, "US"), (4, "OK"), (4, "US")}
    ref = {}
    for r in regional.refinement_plans(df, "i", "l", "r", "s", "st", F.lit(False), most=7).collect():
        ref.setdefault(r["i"], []).append(r["strategy"])
    assert len(ref[1]) == 7 and sorted(ref[3]) == ["B1-exact", "B3-first-initial-fuzzy", "F3-nickname"] and 4 not in ref and 2 not in ref
    p = spark.createDataFrame([(0.0,), (0.4,), (0.65,), (2.0,)], "s double").select(F.round(regional.match_probability("s"), 4).alias("y"))
    assert [r["y"] for r in p.collect()] == [0.0, 0.175, 0.675, 0.99]
