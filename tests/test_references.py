"""References without records against a brute-force search, and their edge cases."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from rollweave.operators.references import Reference, Target, number_key, orphan_report, orphans, slug_key

REFS = "rid long, k string, at timestamp, key string, `end` string"
ROWS = "k string, s timestamp, e timestamp, ns string"


def run(spark, refs, rows, start=True):
    c = F.col
    r = spark.createDataFrame(refs, REFS)
    t = spark.createDataFrame(rows, ROWS)
    return {tuple(x) for x in orphans([Reference("t", "f", r, c("rid"), slug_key(c("k")), c("at"), "x")], [Target("x", t, slug_key(c("k")), c("s") if start else None, c("e"))]).collect()}


def test_against_brute_force(spark):
    rng = random.Random(5)
    day = lambda: datetime(2025, 1, 1) + timedelta(hours=rng.randrange(24 * 200))
    rows = []
    for i in range(150):
        s = day()
        rows.append((f"k{rng.randrange(60)}", s, rng.choice([None, s + timedelta(hours=rng.randrange(-50, 3000))]), "clash"))
    refs = [(i, rng.choice([f"k{rng.randrange(80)}", f" K{rng.randrange(80)} "]), day(), "clash", "clash") for i in range(600)]
    refs += refs[:20]
    there = {}
    for k, s, e, _ in rows:
        there.setdefault(k, []).append((s, e))
    want = {("t", "f", i, at.strftime("%Y-%m")) for i, k, at, _, _ in refs if not any(s <= at and (e is None or e > at) for s, e in there.get(k.strip().lower(), []))}
    assert run(spark, refs, rows) == want


def test_edges(spark):
    t = datetime(2025, 3, 5, 12)
    refs = [(1, "a", t, "", ""), (1, "a", t, "", ""), (2, None, t, "", ""), (3, "  ", t, "", ""), (4, "b", None, "", ""), (5, "c", None, "", ""), (6, "d", t, "", "")]
    rows = [("a", t, t, "z"), ("b", t, None, "z"), (None, t, None, "z"), ("d", t, t + timedelta(seconds=1), "z")]
    # removed at the recording instant: never there; a missing time is held against all times
    assert run(spark, refs, rows) == {("t", "f", 1, "2025-03"), ("t", "f", 5, "")}
    assert run(spark, [], rows) == set()
    assert run(spark, [(1, "a", t, "", "")], []) == {("t", "f", 1, "2025-03")}
    # targets without a beginning are there until they end
    assert run(spark, [(1, "a", t, "", ""), (2, "b", t, "", "")], [("a", None, t, "z"), ("b", None, None, "z")], start=False) == {("t", "f", 1, "2025-03")}


def test_keys(spark):
    rows = ["000106276", "FaG ID: 102236", "#100691", "https://g.example/memorial/102462/a_b-7", " 100070 ", "none", "", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, x string").select("i", number_key(F.col("x")).alias("k")).orderBy("i")
    assert [r["k"] for r in df.collect()] == ["106276", "102236", "100691", "102462", "100070", "none", "", ""]


def test_report(spark):
    found = spark.createDataFrame([("t", "f", 1, "2025-01"), ("t", "f", 2, "2025-01"), ("t", "g", 1, "")], "ref_table string, ref_field string, row_id long, period string")
    assert {tuple(r) for r in orphan_report(found).collect()} == {("t", "f", "2025-01", 2), ("t", "g", "", 1)}
