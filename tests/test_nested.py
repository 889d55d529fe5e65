"""Shared inlining against a plain recursive walk."""

import json
import random

from pyspark.sql import functions as F

from rollweave.operators.nested import element_table, plan_layout, read_json, schema_graph, shred, struct_tables


def person(rng, depth):
    x = {rng.choice(["memorial_id", "memorialId"]): rng.choice([str(rng.randrange(99)), rng.randrange(99), "", None]), "details": {"year": rng.randrange(9), "place": {"state": "OK"}}}
    if rng.random() < 0.2:
        x = {"slug": "none"}
    if depth and rng.random() < 0.6:
        x["family"] = rng.choice([None, [], person(rng, depth - 1), [person(rng, depth - 1), None, person(rng, depth - 1)]])
    return x


def walk(x, path, out, doc):
    if x is None:
        return
    for i, y in enumerate(x if isinstance(x, list) else [x]):
        if isinstance(y, dict):
            here = f"{path}/{i}"
            m = y.get("memorial_id", y.get("memorialId"))
            if m is not None and str(m) != "":
                out.add((doc, here, str(m)))
            walk(y.get("family"), here, out, doc)


def test_against_walk(spark):
    rng = random.Random(3)
    docs, want = [], set()
    for i in range(200):
        cands = [person(rng, 4) for _ in range(rng.randrange(4))]
        j = rng.choice([{"pages": [{"page": 1, "candidates": cands}, {"page": 2, "candidates": cands[0] if cands else None}]}, {"candidates": cands}, {"query": {}}, {"pages": None, "candidates": cands}])
        text = json.dumps(j)
        for _ in range(rng.choice([0, 0, 0, 1, 2])):  # JSON written as a string
            text = json.dumps(text)
        docs.append((f"o{i}", text, "clash"))
        if j.get("pages"):
            for k, p in enumerate(j["pages"]):
                walk(p.get("candidates"), str(k), want, f"o{i}")
        else:
            walk(j.get("candidates"), "0", want, f"o{i}")
    docs += [("bad", '{"candidates": [{"memorial_id": "1"', "c"), ("null", None, "c"), ("empty", "", "c"), ("list", "[1, 2]", "c"), (None, '{"candidates": {"memorial_id": "7"}}', "c"), docs[0]]
    want.add(("", "0/0", "7"))
    df = spark.createDataFrame(docs, "k string, payload string, path string")
    graph = [(r["parent"], r["child"], r["kind"], r["repeated"]) for r in schema_graph(df, "payload").collect()]
    layout = plan_layout(graph, {"memorialId": "memorial_id"}, (("pages", "candidates"),))
    assert {"candidates", "family", "pages"} <= layout.tables and layout.inlined["place"] == "details"
    rows = shred(df, "k", "payload", layout, "memorial_id").where("element in ('candidates', 'family')").collect()
    assert {(r["parent_id"], r["path"], r["child_id"]) for r in rows if r["child_id"]} == want
    assert all(r["path"].startswith(r["parent_path"]) for r in rows)
    found = shred(df, "k", "payload", layout, "memorial_id")
    people = element_table(found, layout, "candidates").unionByName(element_table(found, layout, "family"), allowMissingColumns=True)
    assert people.columns == ["parent_id", "path", "parent_path", "memorial_id", "slug"] and dict(people.dtypes)["memorial_id"] == "string"
    details = element_table(found, layout, "details")
    assert dict(details.dtypes)["year"] == "bigint" and {r["place_state"] for r in details.collect()} == {"OK"}
    assert {(r["parent_id"], r["path"], r["memorial_id"].strip()) for r in people.where("trim(memorial_id) <> ''").collect()} == want
    assert people.alias("c").join(found.alias("p"), F.expr("c.parent_id = p.parent_id and c.parent_path = p.path")).count() >= people.where("parent_path like '%/%'").count() > 0


def test_deep_and_damaged(spark):
    deep = '{"family": ' * 300 + '{"memorial_id": "9"}' + "}" * 300
    assert read_json("x") is None and read_json(None) is None and read_json("﻿ {}x") == {} and read_json('{"a": 1} junk') == {"a": 1}
    df = spark.createDataFrame([("d", deep)], "k string, payload string")
    graph = [(r["parent"], r["child"], r["kind"], r["repeated"]) for r in schema_graph(df, "payload").collect()]
    layout = plan_layout(graph)
    assert "family" in layout.tables
    found = shred(df, "k", "payload", layout, "memorial_id", keep_fields=False).where("child_id <> ''").collect()
    assert [(r["path"], r["child_id"]) for r in found] == [("/".join(["0"] * 300), "9")]
    assert shred(df.limit(0), "k", "payload", layout, "memorial_id").count() == 0 and schema_graph(df.limit(0), "payload").count() == 0


def test_struct_tables(spark):
    rows = [(1, [{"id": 5, "path": "x", "at": {"town": "A"}, "kin": [{"id": 50}, None]}, None, {"id": None}, {"id": 6, "kin": []}]), (2, []), (3, None), (None, [{"id": 7}])]
    df = spark.createDataFrame(rows, "p long, a array<struct<id:long, path:string, at:struct<town:string>, kin:array<struct<id:long>>>>")
    t = struct_tables(df, "p", "a")
    assert t["a"].columns == ["parent_id", "path", "parent_path", "id", "path_", "at_town"]
    assert {tuple(r) for r in t["a"].collect()} == {("1", "0", "", 5, "x", "A"), ("1", "2", "", None, None, None), ("1", "3", "", 6, None, None), ("", "0", "", 7, None, None)}
    assert [tuple(r) for r in t["a.kin"].collect()] == [("1", "0/0", "0", 50)] and struct_tables(df.limit(0), "p", "a")["a.kin"].count() == 0
    one = struct_tables(spark.createDataFrame([(1, (3,)), (2, None)], "p long, s struct<id:long>"), "p", "s")
    assert {tuple(r) for r in one["s"].collect()} == {("1", "0", "", 3)}
