"""Connected groups on the grid against union-find, and accepted pairs."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rollweave.llm.groups import accepted_pairs, connected_groups


def brute(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        if a and b and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("cell", [10, 40, 10_000])
def test_against_union_find(spark, cell):
    rng = random.Random(cell)
    v = lambda: f"p:{rng.randrange(150):04d}"
    edges = [(v(), v()) for _ in range(90)] + [(f"c:{i:04d}", f"c:{i + 1:04d}") for i in range(120)] + [("h:0000", f"h:{i:04d}") for i in range(1, 90)] + [(None, "p:0001"), ("", "p:0002"), ("p:0003", "p:0003")]
    df = spark.createDataFrame([(a, b, "clash") for a, b in edges * 2], "a string, b string, vertex string")
    got = {r["ref"]: r["group_ref"] for r in connected_groups(df, "a", "b", cell).collect()}
    assert got == brute(edges)


def test_estimates_do_not_grow_with_rounds(spark):
    chain = spark.range(400).selectExpr("format_string('c:%04d', id) as a", "format_string('c:%04d', id + 1) as b")
    found = connected_groups(chain.unionByName(spark.range(1_200).selectExpr("format_string('d:%04d', id) as a", "format_string('d:%04d', id + 1) as b")), "a", "b", 40)
    assert found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 400
    assert found.groupBy("group_ref").count().count() == 2


def test_empty(spark):
    assert connected_groups(spark.createDataFrame([], "a string, b string"), "a", "b").collect() == []


def test_accepted_pairs(spark):
    t = datetime(2025, 1, 1)
    rows = [(1, "a", "b", "match", t), (2, "B ", "a", "no_match", t + timedelta(days=1)), (3, "c", "d", "no_match", t), (4, "d", "c", "MATCH", t), (5, "e", "e", "match", t), (6, None, "f", "match", t), (7, "", "g", "match", t), (8, "h", "i", "match", None), (9, "j", "k", "unsure", t), (10, "x", "y", None, t)]
    df = spark.createDataFrame(rows, "pid long, ra string, rb string, v string, at timestamp")
    c = F.col
    assert {tuple(r) for r in accepted_pairs(df, c("ra"), c("rb"), c("v"), c("at"), c("pid")).collect()} == {("c", "d"), ("h", "i")}
