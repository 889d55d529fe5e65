"""Cross references on small cases, against what each should say."""

import json

import pytest
from pyspark.sql import functions as F

from rollweave.config import RecipeError, read_recipe, recipe, start_run
from rollweave.functions.ingest import overlaid, pensioner_record
from rollweave.operators import crossref, learning, state
from rollweave.operators.prefix import running_sums, with_next

CANDIDATES = "array<struct<id:long, slug:string, first:string, last:string>>"


def test_curated(spark):
    rows = [
        (1, "Smith.", "john", [(7, "a", None, None), None, (8, "john-smith/", None, None), (9, "x", None, None)]), (2, "SMITH", "J.", [(5, None, None, None)]), (3, "", "john", [(8, "", None, None)]), (4, "Smith", "Mary", [(8, "", None, None)]), (5, "Smith", "John", None), (6, None, None, []),
    ]
    df = spark.createDataFrame(rows, f"k long, last string, first string, c {CANDIDATES}")
    curated = spark.createDataFrame([("smith", "Jack", 8, "John-Smith"), ("smith", "Jack", 8, "John-Smith"), ("smith", "J", 9, ""), (None, "J", 7, ""), ("smith", "J", None, "")], "last string, first string, id long, slug string")
    found = lambda **k: {tuple(r) for r in crossref.curated_matches(df, "k", "last", "first", "c", curated, **k).collect()}
    assert found(top_n=4) == {(1, 3, 8)} == found(top_n=4, strict=True) and found(top_n=2) == set()
    assert crossref.match_ranks(crossref.curated_matches(df, "k", "last", "first", "c", curated.limit(0), 4)).collect() == []


def test_spouse_probe(spark):
    c = lambda f, l: (1, "", f, l)
    rows = [(1, "Ann", "Lee", [c("Bo", "Ray"), None, c("Mary", "Lee Jr"), c("Ann", "Lee")]), (2, "Ann", "Lee", [c("Ann", "Lee."), c("Ann", "Lee")]), (3, "Ann", None, [c("Ann", "Lee")]), (4, "Ann", "Lee", [])]
    df = spark.createDataFrame(rows, f"k long, first string, last string, c {CANDIDATES}")
    got = {r["k"]: (r["rank"], r["strength"], r["outcomes"]) for r in crossref.spouse_probe(df, "k", "first", "last", "c", "first", "last", 4).collect()}
    assert got == {1: (3, "medium", ["no", "no", "medium", "skipped"]), 2: (1, "strong", ["strong", "skipped"]), 3: (0, None, ["no"])}


def test_enrichment_and_links(spark):
    log = spark.createDataFrame([(1, "A", "x", 1), (1, "A", "y", 2), (0, "A", "z", 9), (None, "A", "z", 9), (2, "B", "b", 1), (2, "C", "c", 1)], "k long, kind string, p string, at long")
    last = crossref.latest_payloads(log, "k", "kind", "p", ["at"], {"A": "a", "B": "b"})
    rows = spark.createDataFrame([(1, None), (2, None), (3, None), (4, "own")], "k long, a string")
    assert {tuple(r) for r in crossref.enriched(rows, "k", last).select("k", "a", "b", "enriched").collect()} == {(1, "y", None, True), (2, None, "b", True), (3, None, None, False), (4, "own", None, False)}
    source = spark.createDataFrame([(1, "u1", 1), (1, "u2", 2), (2, None, 1), (2, "late", 2), (None, "n", 1)], "k long, a string, at long")
    got = {tuple(r) for r in crossref.backfilled_links(rows, "k", "a", source, ["at"]).collect()}
    assert got == {(1, "u1", "filled"), (2, "", "missing"), (3, "", "missing"), (4, "own", "skipped")}


def test_pages(spark):
    df = spark.createDataFrame([(1, "https://x/iiif/2/pensioncard:77/full"), (2, "https://x/iiif/2/pensioncard:78/full"), (3, "nothing"), (4, None)], "k long, url string")
    side = spark.createDataFrame([(2, [5, 6]), (3, [])], "k long, pages array<long>")
    assert {(r["k"], tuple(r["pages"] or ()), r["pages_from"]) for r in crossref.with_pages(df, "k", "url", side).collect()} == {(1, (77,), "derived"), (2, (5, 6), "sidecar"), (3, (), "none"), (4, (), "none")}
    assert crossref.with_pages(df, "k", "url").where("pages_from = 'derived'").count() == 2
    answers = [('{"objectInfo": {"page": [{"pageptr": "11"}, {"pageptr": 12}]}}', 9), ('{"objectInfo": {"code": -2}}', 9), (None, 9)]
    assert [r[0] for r in spark.createDataFrame(answers, "a string, c long").select(crossref.page_ids("a", "c")).collect()] == [[11, 12], [9], []]


def test_names(spark):
    rows = [("John", "Q", "Smith", "Jack", "Quincy", "Smith", 0.85), ("J", "", "Smith", "John", "", "Smith", 0.5), ("Ann", "", "Lee", "Ann", "", "Leeson", 0.6), ("", "", "", "", "", "", 0.85), (None, None, "x", "y", None, None, 0.0)]
    df = spark.createDataFrame(rows, "a string, b string, c string, x string, y string, z string, want double")
    assert all(abs(r[0] - r[1]) < 1e-9 for r in df.select(crossref.name_evidence("a", "b", "c", "x", "y", "z"), "want").collect())
    rows = [("Ann", "ann", "", "", "strong"), ("Fayette", "Fannie", 'Fayette "Fannie" Rogers', None, "strong"), ("Sara", "Sarah", "", "", "loose"), ("J", "John", "", "", "loose"), ("Jo", "Ann", "", "", None), ("", "Ann", "", "", None)]
    df = spark.createDataFrame(rows, "a string, b string, wa string, wb string, want string")
    assert [r[0] for r in df.select(crossref.first_name_strength("a", "b", "wa", "wb")).collect()] == [r[4] for r in rows]
    rows = [("Ann", "Lee", "Ann", "LEE", "Robert Lee", "Lee", "strong"), ("Ann", "Lee", "A", "Lee", "Robert Lee", "Lee", "loose"), ("Ann", "Lee", "Ann", "Lee", "", "Lee", "loose"), ("Ann", "Lee", "Ann", "Lee", "Joe Ray", "Lee", None), ("Ann", "Lee", "Ann", "Ray", "", "Lee", None)]
    df = spark.createDataFrame(rows, "f string, l string, wf string, wl string, h string, s string, want string")
    assert [r[0] for r in df.select(crossref.widow_verdict("f", "l", F.lit(""), "wf", "wl", F.lit(""), "h", "s")).collect()] == [r[6] for r in rows]


def test_rosters_and_evaluation(spark):
    roster = spark.createDataFrame([("Smith", "John", "TX"), ("Smith", "Jane", "AL"), ("", "X", "TX")], "last string, first string, state string")
    df = spark.createDataFrame([(1, "Smith", "J.", "8th TX Cavalry"), (2, "Smith", "Joe", "8th GA Cav"), (3, "Smith", "Joe", None), (4, "Ray", "Joe", ""), (5, "", "Joe", "")], "k long, last string, first string, unit string")
    assert {tuple(r) for r in crossref.roster_join(df, "k", "last", "first", "unit", roster).collect()} == {(1, "matched"), (2, "other state"), (3, "matched"), (4, "no roster entry"), (5, "no name")}
    p = spark.createDataFrame([(1, "auto_accept"), (2, "auto_accept"), (3, "low"), (4, "low"), (5, None)], "k long, s string")
    t = spark.createDataFrame([(1, "accepted"), (2, "rejected"), (3, "accepted"), (4, "rejected")], "k long, d string")
    assert tuple(crossref.evaluation(p, t, "k", "s", "d").first()) == (5, 3, 0.6, 0.5, 0.5) and tuple(crossref.evaluation(p.limit(0), t, "k", "s", "d").first()) == (0, 0, 0.0, 0.0, 0.0)
    model = spark.createDataFrame([(0.0, 1.0)], "a double, b double")
    scores = spark.createDataFrame([(1, 0.0)], "k long, s double")
    assert learning.calibrated_decisions(scores, "s", model).first()["calibrated_probability"] == 0.5 and learning.calibrated_decisions(scores, "s", model.limit(0)).first()["calibrated_probability"] is None


def test_prefix(spark):
    df = spark.createDataFrame([(float(i % 50), i) for i in range(300)], "x double, v long").repartition(7)
    got = {(r["x"], r["v"]): r["run"] for r in running_sums(df, [F.col("x")], {"v": "run"}).collect()}
    assert got == {(float(i % 50), i): sum(j for j in range(300) if j % 50 <= i % 50) for i in range(300)}
    nxt = {r["x"]: r["n"] for r in with_next(df.select("x").distinct(), "x", "n").collect()}
    assert nxt == {float(i): float(i + 1) if i < 49 else None for i in range(50)}


def test_state(spark):
    t = lambda s: F.lit(f"2026-01-01 {s}").cast("timestamp")
    known = spark.createDataFrame([("a", "1"), ("b", "2")], "provider string, not_before string")
    assert {tuple(r) for r in state.with_cooldowns(known, spark.createDataFrame([("b", "5"), ("b", "4"), ("c", "1")], "provider string, not_before string")).collect()} == {("a", "1"), ("b", "5"), ("c", "1")}
    items = spark.createDataFrame([("w1", "ready", None, None, 0), ("w2", "leased", None, "2025-01-01", 1), ("w3", "succeeded", None, None, 1), ("w4", "ready", None, None, None)], "w string, state string, nb string, lease string, attempt int").selectExpr("w", "state", "cast(nb as timestamp) nb", "cast(lease as timestamp) lease", "attempt")
    got = state.claimed(items, "state", "nb", "lease", t("00:00:00"), "me", 60, ["w"], 2).collect()
    assert [(r["w"], r["state"], r["leased_by"], r["attempt"]) for r in got] == [("w1", "leased", "me", 1), ("w2", "leased", "me", 2)]
    p = state.progress(items, F.col("state") == "succeeded", 4, t("00:00:00"), t("00:01:00")).first()
    assert tuple(p) == (1, 4, 25.0, 60.0, 180.0)
    n = spark.createDataFrame([(f"a{i}",) for i in range(9)] + [("b",)], "x string")
    assert [r["x"] for r in state.batch(n, ["x"], ("x", "a"), 2, 5).collect()] == ["a2", "a3", "a4"] and sorted(r["x"] for r in state.batch(n, ["x"], seed=3).collect()) == sorted(r["x"] for r in n.collect())


def test_records(spark):
    df = spark.createDataFrame([(5, {"title": "Smith, John Q.", "spouse": "Smith, Ann", "regime": "8 TX", "creato": "c"}), (6, {})], "id long, f map<string,string>")
    r = df.select(pensioner_record(F.col("id"), "pensions", F.col("f"), "https://cards.example").alias("r")).select("r.*").orderBy("id").collect()
    assert (r[0]["last_name"], r[0]["spouse_first_name"], r[0]["regiment"], r[0]["creator"], r[0]["backlink"]) == ("Smith", "Ann", "8 TX", "c", "https://cards.example/collection/pensions/id/5") and r[1]["name_raw"] == ""
    base = spark.createDataFrame([(1, "u", 1840), (2, "v", None), (3, "w", None), (4, "x", None)], "id long, unit string, born int")
    details = spark.createDataFrame([(1, {"unit": "U", "born": "1841", "_mark": "m"}), (2, None), (3, {})], "id long, fields map<string,string>")
    got = {tuple(x) for x in overlaid(base, "id", details, F.lit("now")).collect()}
    assert got == {(1, "U", 1841, "now", None), (2, "v", None, None, "fetch_failed"), (3, "w", None, None, "empty_details"), (4, "x", None, None, None)}


def test_recipe(tmp_path):
    old = recipe({"runname": "run-1", "input": "a.json", "cgr": "b.jsonl", "throttle": 1.0, "end_row": 9})
    assert old["version"] == 2 and old["inputs"] == {"pensioners": "a.json", "cgr": "b.jsonl", "start_row": 0, "end_row": 9} and old["engine"]["throttle"] == 1.0
    new = recipe({"version": 2, "runname": "r", "pipeline": {"mode": {"mode": "aggressive", "max_refinements": 3}}})
    assert new["pipeline"]["mode"] == {"mode": "aggressive", "max_refinements": 3, "skip_refine_above": 0.85, "bail_on_auto_accept": False} and recipe(new) == new
    for bad in ({"runname": "Bad Name"}, {"version": 2, "runname": "r", "pipeline": {"mode": {"mode": "x"}}}, {"version": 2, "runname": "r", "pipeline": {"modules": ["x"]}}, {"version": 2, "runname": "r", "inputs": {"start_row": 5, "end_row": 2}}):
        with pytest.raises(RecipeError):
            recipe(bad)
    path = start_run("run_1", str(tmp_path))
    assert read_recipe(path)["runname"] == "run_1"
    with pytest.raises(RecipeError):
        start_run("run_1", str(tmp_path))
    (tmp_path / "x.json").write_text("{")
    for missing in ("x.json", "y.json"):
        with pytest.raises(RecipeError):
            read_recipe(str(tmp_path / missing))
    assert json.loads((tmp_path / "run_1" / "config.json").read_text())["version"] == 2
