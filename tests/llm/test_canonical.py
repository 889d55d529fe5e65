"""Typed units mapped to a small list."""

import pytest

from rollweave.llm import canonical
from rollweave.llm.canonical import Gazetteer, map_to_list

LIST = [(1, "10th Alabama Infantry", "AL", 10, "Infantry", "Reed's Guards"), (2, "10th Alabama Cavalry", "AL", 10, "Cavalry", None), (3, "46th Louisiana Infantry", "LA", 46, "Infantry", None), (4, "8th Louisiana Infantry", "LA", 8, "Infantry", None), (5, "Whitenley's Florida Sharpshooters", "FL", None, "Sharpshooters", None), (6, "3rd South Carolina Light Artillery", "SC", 3, "Light Artillery", None)]
CASES = {
    "Co. B, 10th Regt. Ala. Inf. Vols, C.S.A.": [1], "Alabama Calvary, 10th": [2], "10 AL": [], "8th & 46th Louisiana Infantry": [3, 4], "46 LA": [3], "46th La. Cavalry": [], "Forty-sixth Lousiana Infty": [3], "Sharpshooters, Florida (Whitenley)": [5], "Whtenleys Fla. Sharpshooters": [5],
    "Reeds Guards, AL": [1], "3rd S. C. Artillery (light)": [6], "3d S.C. Lt. Arty": [6], "47th Louisiana Infantry": [], "46th Louisiana Infantry; later 8th Louisiana Infantry": [3, 4], "unknown": [], "?": [], "46th L0uisiana Infantry": [3], "x" * 20_000: [],
}


@pytest.mark.parametrize("value", CASES)
def test_mentions(value):
    assert Gazetteer(LIST).mentions(value) == CASES[value]


def test_rows(spark):
    listed = spark.createDataFrame(LIST, "regiment_id long, canonical_name string, state string, unit_number int, branch string, aka string")
    typed = [(i, v) for i, v in enumerate(CASES)] + [(0, next(iter(CASES))), (90, None), (91, "    "), (92, "unknown"), (92, "46 LA"), (93, "unknown"), (93, "n/a")]
    df = spark.createDataFrame([(i, v, 9) for i, v in typed], "rid long, typed string, entry_id int")
    args = ("regiment_id", "canonical_name", "state", "unit_number", "branch", "aka")
    got = {}
    for r in map_to_list(df, "rid", "typed", listed, *args).collect():
        got.setdefault(r["record_id"], []).append(r["entry_id"])
    want = {i: CASES[v] or [0] for i, v in enumerate(CASES)} | {92: [3], 93: [0]}
    assert {k: sorted(v) for k, v in got.items()} == want
    assert map_to_list(df.limit(0), "rid", "typed", listed, *args).collect() == []
    assert {r["entry_id"] for r in map_to_list(df, "rid", "typed", listed.limit(0), *args).collect()} == {0}


def test_bound(spark, monkeypatch):
    monkeypatch.setattr(canonical, "LIST_BOUND", 2)
    listed = spark.createDataFrame(LIST, "regiment_id long, canonical_name string, state string, unit_number int, branch string, aka string")
    with pytest.raises(ValueError):
        map_to_list(spark.createDataFrame([(1, "x")], "a long, b string"), "a", "b", listed, "regiment_id", "canonical_name", "state", "unit_number", "branch", "aka")
