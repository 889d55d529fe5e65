"""Learning, the log, projection, parsing, sources, sinks and streams."""

import json
import random
import sqlite3
import zipfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from rollweave.functions import parse
from rollweave.operators import analytics, learning, projection, state
from rollweave.sources import readers, sinks
from rollweave.streaming import log as stream

T0 = datetime(2025, 1, 1)


def test_learning(spark):
    rng = random.Random(1)
    rows = [(rng.random() < 0.4, round(rng.random(), 1)) for _ in range(70)]
    df = spark.createDataFrame(rows, "y boolean, s double")
    sweep = {round(r["threshold"], 4): (r["tp"], r["fp"], r["fn"], r["tn"], r["f1"]) for r in learning.threshold_sweep(df, "y", "s").collect()}
    scores = sorted({s for _, s in rows})
    assert set(sweep) == {round(x, 4) for x in [0, 1, *scores, *((a + b) / 2 for a, b in zip(scores, scores[1:]))]}
    for t, (tp, fp, fn, tn, _) in sweep.items():
        assert (tp, fp, fn, tn) == (sum(y and s >= t for y, s in rows), sum(not y and s >= t for y, s in rows), sum(y and s < t for y, s in rows), sum(not y and s < t for y, s in rows))
    best = learning.best_threshold(learning.threshold_sweep(df, "y", "s")).first()
    assert round(best["threshold"], 4) == min(t for t, v in sweep.items() if v[4] == max(x[4] for x in sweep.values()))
    ordered, n = sorted((s, y) for y, s in rows), len(rows)
    want = {i: (round(sum(s for s, _ in c) / len(c), 3), round(sum(y for _, y in c) / len(c), 3)) for i in range(10) if (c := ordered[i * n // 10 : (i + 1) * n // 10])}
    assert {r["bucket"]: (pytest.approx(r["avg_score"], abs=1e-3), pytest.approx(r["avg_accepted"], abs=1e-3)) for r in learning.deciles(df, "y", "s").collect()} == want
    assert learning.score_for_probability(-6.0, 10.0) == pytest.approx(0.894, abs=2e-3)
    flat = learning.linear_calibration(df.withColumn("s", F.lit(0.5)), "y", "s").first()
    assert (flat["a"], flat["b"]) == (0.0, 0.0)
    deltas = spark.createDataFrame([(1.0, -1.0)] * 8 + [(0.5, 0.0)] * 2, "a double, b double")
    w = learning.pairwise_weights(deltas, ["a", "b"], {"a": 1.0, "b": 1.0}, steps=5)
    assert w["a"] == 2.0 and w["b"] < w["a"] and learning.pairwise_weights(deltas.limit(0), ["a"], {"a": 1.5}) == {"a": 1.5}


def test_log(spark):
    rows = [("o1", T0, "a"), ("o1", T0 + timedelta(1), "late"), ("o2", T0, "b")]
    df = spark.createDataFrame(rows, "oid string, at timestamp, x string")
    assert {r["oid"]: r["x"] for r in state.first_per_id(df, "oid", ["at"]).collect()} == {"o1": "a", "o2": "b"}
    batch = spark.createDataFrame([("o2", T0, "z"), ("o3", T0, "c"), ("o3", T0, "c")], "oid string, at timestamp, x string")
    assert [r["oid"] for r in state.append_new(df, batch, "oid", ["at"]).collect()] == ["o3"]
    assert {r["oid"]: r["x"] for r in state.last_per_key(df, ["oid"], "at", "x", ["x"]).collect()} == {"o1": "late", "o2": "b"}
    assert state.since(df, "at", "oid", "2025-01-01 00:00:00", "o1").count() == 2 and state.since(df, "at", "oid", None, None).count() == 3
    one, two = state.digest(df.repartition(3), "oid").first(), state.digest(df.orderBy(F.desc("x")), "oid").first()
    assert one == two and state.digest(df.limit(1), "oid").first()["digest"] != one["digest"]
    cover = {tuple(r) for r in state.id_coverage(df, spark.createDataFrame([("o1",), ("o9",)], "oid string"), "oid").collect()}
    assert cover == {("o1", "repeated"), ("o2", "unexpected"), ("o9", "missing")}
    w = spark.createDataFrame([("a", "ready", None, None), ("b", "retryable", T0 + timedelta(2), None), ("c", "leased", None, T0 - timedelta(1)), ("d", "leased", None, None), ("e", "terminal", None, None)], "i string, st string, nb timestamp, lease timestamp")
    assert {r["i"] for r in state.claimable(w, "st", "nb", "lease", F.lit(T0)).collect()} == {"a", "c"}
    assert {r["x"] for r in state.update_by_key(df, "oid", spark.createDataFrame([("o1", "new")], "oid string, x string"), ["x"]).collect()} == {"new", "b"}
    d = spark.createDataFrame([("k", float(v)) for v in (1, 1, 2, 3, 9)] + [("z", None)], "k string, v double")
    assert [tuple(r) for r in analytics.nearest_rank(d, "k", "v", 0.5).collect()] == [("k", 2.0)] and analytics.nearest_rank(d, "k", "v").first()["p95"] == 9.0
    e = spark.createDataFrame([("w", T0, "claim"), ("w", T0 + timedelta(seconds=5), "done"), ("w", T0 + timedelta(seconds=9), "claim")], "w string, at timestamp, e string")
    assert [r["seconds"] for r in analytics.paired_durations(e, "w", "at", "e", "claim", "done").collect()] == [5.0]


def test_projection(spark):
    df = spark.createDataFrame([(1, "Ann", "Lee", T0, 0.9, "Q7"), (2, None, None, T0, None, "x")], "i long, f string, l string, at timestamp, s double, q string")
    rec = {r["i"]: json.loads(r["record"]) for r in projection.linked_data(df, "i", {"schema:givenName": "f"}, "r", "1", [projection.entity_link("q")], F.col("at")).collect()}
    assert rec[1]["sameAs"] == ["http://www.wikidata.org/entity/Q7"] and "sameAs" not in rec[2] and rec[2]["schema:givenName"] == "" and rec[1]["@id"].endswith(":1")
    assert [r[0] for r in df.orderBy("i").select(projection.display_name("l", "f")).collect()] == ["Lee, Ann", ""]
    ev = spark.createDataFrame([("work_claimed", T0, "w1"), ("cooldown_set", T0, ""), ("odd", T0, "x")], "e string, at timestamp, n string")
    assert {(r["class_uid"], r["part"], r["detail"]) for r in projection.security_events(ev, "e", F.col("at"), {"name": "n"}).collect()} == {(1006, "job", '{"name":"w1"}'), (7003, "remediation", "{}")}
    out, failed = projection.run_passes(df, [("a", lambda d: d.withColumn("z", F.lit(1))), ("b", lambda d: d.select("nope"))])
    assert "z" in out.columns and list(failed) == ["b"]
    u = projection.unify(spark.createDataFrame([(" ", "Bo")], "first string, pensioner_first string"), {"first": ["first", "pensioner_first"], "gone": ["x"]}).first()
    assert tuple(u) == ("Bo", "")


def test_parse(spark):
    card = "William Looney  V Veteran 1841 – 1 Jan 1932 Flowers have been left. Rose Hill Cemetery, Eolian, Stephens County, Texas"
    r = spark.createDataFrame([(card,), (None,)], "c string").select(parse.parse_card("c").alias("p")).collect()[0]["p"]
    assert (r["is_veteran"], r["birth_year"], r["death_year"], r["state"]) == (False, "1841", "1932", "TX") and r["cemetery"].endswith("Rose Hill Cemetery")
    k = spark.createDataFrame([("Just a moment...", "", ""), ("Error 1015", "", ""), ("", "Attention Required", ""), ("", "", "x/challenge"), ("ok", None, None)], "t string, b string, u string").select(parse.classify_response("t", "b", "u").alias("k"))
    assert [x["k"]["kind"] for x in k.collect()] == ["challenge", "rate_limited", "blocked", "challenge", "normal"]
    parse.register_parsers(spark)
    page = "<table><tr><th>Name</th></tr><tr><td>A &amp; B</td><td><b>1</b></td></tr><tr><td>C</td></tr></table>"
    assert [(r["place"], r["cells"]) for r in spark.sql(f"SELECT * FROM table_rows('{page}')").collect()] == [(0, ["A & B", "1"]), (1, ["C"])]
    labels = spark.sql("SELECT * FROM label_values('<b>State:</b> OK<br><b>State</b>: TX<br>')").collect()
    assert [(r["label"], r["seen"], r["value"]) for r in labels] == [("State", 0, "OK"), ("State", 1, "TX")]
    assert spark.sql("SELECT * FROM table_rows(NULL)").collect() == []
    n = spark.sql("""SELECT * FROM notice_blocks('<div id="12"><a href="/image/7/?match=3&amp;x=1"><h2>Times</h2></a>Saturday, August 22, 1896<span aria-label="Location">Ada, OK</span></div>')""").first()
    assert (n["id"], n["title"], n["iso_date"], n["location"], n["match_position"]) == ("12", "Times", "1896-08-22", "Ada, OK", "3")
    s = spark.sql("""SELECT * FROM spouse_section('<b>Spouse</b><a href="/memorial/9/ann-lee">Ann Q Lee 1850-1900</a> (m. 1870)')""").first()
    assert (s["first"], s["middle"], s["last"], s["memorial_id"], s["marriage_year"]) == ("Ann", "Q", "Lee", "9", "1870")


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"i": 1}, {"i": 2}]')
    (tmp_path / "b.jsonl").write_text('{"i": 1}\n\n{bad\n{"i": 3}\n')
    assert [r["i"] for r in readers.json_any(spark, str(tmp_path / "a.json"), "i int").collect()] == [1, 2]
    assert [r["i"] for r in readers.json_any(spark, str(tmp_path / "b.jsonl"), "i int").collect()] == [1, 3]
    with pytest.raises(Exception):  # noqa: B017
        readers.json_lines(spark, str(tmp_path / "b.jsonl"), "i int", strict=True).collect()
    (tmp_path / "csa_tx_4.csv").write_text("﻿title\nnote\nLast,First\nLee,Ann\n\"Poe, Jr\",Ed\n")
    got = readers.csv_after_preamble(spark, str(tmp_path / "csa_tx_4.csv"), ["last", "first"], "Last,", r"^([a-z]+)_([a-z]+)_", ["side", "state"]).collect()
    assert [tuple(r) for r in got] == [("Lee", "Ann", "csa", "tx"), ("Poe, Jr", "Ed", "csa", "tx")]
    db = tmp_path / "x.db"
    with sqlite3.connect(db) as c:
        c.execute("CREATE TABLE s (id INTEGER, name TEXT)")
        c.executemany("INSERT INTO s VALUES (?, ?)", [(i, f"n{i}") for i in range(25)])
    c.close()
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        z.write(db, "data/x.db")
    for path in (db, tmp_path / "x.zip"):
        assert readers.first_readable(spark, "id int, name string", "s", None, str(path)).count() == 25
    assert readers.first_readable(spark, "id int", "s", str(tmp_path / "none.db")).count() == 0
    (tmp_path / "d.json").write_text('{"decisions": {"7": {"m": "x"}}}')
    assert [(r["key"], r["value"]["m"]) for r in readers.keyed_json(spark, str(tmp_path / "d.json"), "decisions", "struct<m:string>").collect()] == [("7", "x")]
    table = str(tmp_path / "t")
    sinks.replace_table(spark.range(3), table)
    snaps = sinks.Snapshots(spark, table, str(tmp_path / "snaps"))
    label = snaps.take()
    sinks.replace_table(spark.read.parquet(table).where("id > 1"), table)
    assert spark.read.parquet(table).count() == 1 and snaps.rollback() == label and spark.read.parquet(table).count() == 3
    with pytest.raises(FileNotFoundError):
        snaps.rollback("none")
    sinks.write_schema(spark.range(1), str(tmp_path / "s.json"), {"id": "key"})
    assert json.loads((tmp_path / "s.json").read_text())["fields"][0]["description"] == "key"


def test_streams(spark, tmp_path):
    rows = [("w1", "enqueued", T0), ("w1", "claimed", T0 + timedelta(seconds=1)), ("w1", "failed", T0 + timedelta(seconds=2)), ("w2", "claimed", T0), ("w2", "succeeded", T0 + timedelta(seconds=9)), ("w2", "failed", T0 + timedelta(seconds=10))]
    rows += [("w3", e, T0 + timedelta(seconds=2 * i + k)) for i in range(3) for k, e in enumerate(("claimed", "failed"))]
    df = spark.createDataFrame(rows, "w string, e string, at timestamp")
    df.write.parquet(str(tmp_path / "log"))
    src = lambda: stream.read_log(spark, str(tmp_path / "log"), df.schema)
    want = {"w1": ("retryable", 1), "w2": ("succeeded", 1), "w3": ("terminal", 3)}
    stream.run_to_memory(stream.work_state_machine(src(), "w", "e", "at"), "machine", "update")
    assert {r["work_id"]: (r["state"], r["attempt"]) for r in spark.table("machine").collect()} == want
    assert {r["work_id"]: (r["state"], r["attempt"]) for r in stream.work_states_batch(df, "w", "e", "at").collect()} == want
    stream.run_to_memory(stream.windowed_counts(src().withColumn("v", F.lit(1)), "at", ["e"], "v", "5 seconds"), "windows", "complete")
    assert spark.table("windows").agg(F.sum("n")).first()[0] == len(rows)
    stream.run_to_memory(stream.sessions(src(), "at", "w", "3 seconds"), "runs", "complete")
    assert spark.table("runs").where("w = 'w2'").count() == 2
    stream.run_to_memory(stream.once_per_id(src(), "w", "at"), "once")
    assert spark.table("once").count() == 3


def test_entry(spark):
    names, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(names) and len(names) > 60
    assert set(entry.entry(spark).columns) >= {"pensioner_id", "status", "top_score"}
