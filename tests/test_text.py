"""Column functions against plain Python."""

import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollweave.functions import phonetic as P
from rollweave.functions import text as T

names = st.text(alphabet="abcdefghijklmnopqrstuvwxyzABCXYZ '-.éüñ0123", max_size=14)
few = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def column(spark, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r["y"] for r in df.select("i", make("x").alias("y")).orderBy("i").collect()]


CODES = dict(zip("abcdefghijklmnopqrstuvwxyz", "01230120022455012623010202"))


def soundex_a(name):
    n = re.sub("[^a-z]", "", name.lower())
    if not n:
        return ""
    out, before = n[0].upper(), "0"
    for ch in n[1:]:
        c = CODES[ch]
        if c != "0" and c != before:
            out += c
        before = c
    return out[:4].ljust(4, "0")


@few
@given(st.lists(names, min_size=20, max_size=40))
def test_normal_forms_and_soundex(spark, values):
    assert column(spark, values, T.normalise) == [re.sub("[^a-z]", "", v.lower()) for v in values]
    folded = ["".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c)).lower() for v in values]
    assert column(spark, values, T.fold_accents) == [re.sub("[^a-z]", "", v) for v in folded]
    assert column(spark, values, P.soundex) == [soundex_a(v) for v in values]


def test_known_soundex(spark):
    assert column(spark, ["Pfister", "Ashcraft", "", None, "Lloyd"], P.soundex) == ["P123", "A226", "", "", "L430"]
    assert column(spark, ["Pfister", "Lloyd"], P.soundex_seeded) == ["P236", "L300"]


def test_splits(spark):
    v = ["John", "John Smith", "John  Q. Public Smith", "", None]
    assert [tuple(r) for r in column(spark, v, T.split_name)] == [("", "", "John"), ("John", "", "Smith"), ("John", "Q. Public", "Smith"), ("", "", ""), ("", "", "")]
    assert [r["first"] for r in column(spark, v, lambda x: T.split_name(x, "first"))][0] == "John"
    assert tuple(column(spark, ["John"], lambda x: T.split_name(x, "both"))[0]) == ("John", "", "John")
    assert [tuple(r) for r in column(spark, ["Smith, John Q", "John Q", "Smith,"], T.split_listed)] == [("John", "Q", "Smith"), ("John", "Q", ""), ("", "", "Smith")]
    got = [tuple(r) for r in column(spark, ["ann-lee", "ann-q-r-lee", "ann_q-lee", "ann_q_r-lee", "ann", "a_b", None], T.slug_parts)]
    assert got == [("ann", "", "lee"), ("ann", "q r", "lee"), ("ann", "q", "lee"), ("ann", "q r", "lee"), ("ann", "", ""), ("a", "b", "b"), ("", "", "")]


def test_places_and_dates(spark):
    assert column(spark, ["Co. B, 3rd TX Inf", "5th West Virginia", "Arkansas", "CO", "", None], T.unit_state) == ["TX", "VA", "AR", "", "", ""]
    assert column(spark, ["west virginia", "x", None], T.origin_state) == ["VA", None, None]
    d = ["abt 1844", "1842-12-08", "x18441", "", None, "b. 1840, d. 1901"]
    assert column(spark, d, T.year_anywhere) == [1844, 1842, 1844, None, None, 1840]
    assert column(spark, d, T.year_leading) == [None, 1842, None, None, None, None]
    assert column(spark, d, T.year_word) == [1844, 1842, None, None, None, 1840]
    assert column(spark, ["Saturday, August 22, 1896", "Sunday, Foo 3, 1896", None], T.long_date) == ["1896-08-22", "", ""]
    assert tuple(column(spark, ["Osage Co. : Rose Hill"], T.county_and_name)[0]) == ("Osage", "Rose Hill")


def test_phrases_and_nicknames(spark):
    u = ["2nd Mississippi & 3rd Mississippi Infantry & Cavalry", "Infantry", "", None]
    assert [list(x) for x in column(spark, u, T.unit_phrases)] == [["2nd Mississippi", "3rd Mississippi", "Cavalry"], ["Infantry"], [], []]
    assert column(spark, u, lambda x: T.best_phrase(T.unit_phrases(x))) == ["2nd Mississippi", "Infantry", "", ""]
    assert [list(x) for x in column(spark, ["Mollie", "zed", None], T.nickname_candidates)] == [["Mamie", "Mary", "May", "Minnie", "Molly", "Polly"], [], []]
    assert [list(x) for x in column(spark, ["Peter", "zed"], T.short_forms)] == [["peter", "pete"], ["zed"]]


def test_markup_and_fields(spark):
    assert column(spark, ["<b>A</b>&nbsp;&amp; b", "", None], T.strip_markup) == ["A b", "", ""]
    assert column(spark, ["Added BY x", None], lambda x: T.strip_phrases(x, ["Added by"])) == ["x", ""]
    assert column(spark, ["John Jr", "A. Jr. ", "Jr"], T.spouse_name) == ["john", "a.", "jr"]
    df = spark.createDataFrame([([("a", " 1 "), ("b", None), (None, "x"), ("a", "2")],)], "f array<struct<key:string,value:string>>")
    assert df.select(T.fields_to_map("f").alias("m")).first()["m"] == {"b": "", "a": "2"}
    ids = spark.createDataFrame([("a", None), ("a", "")], "p string, q string").select(T.stable_id("p", "q").alias("i")).collect()
    assert ids[0]["i"] == ids[1]["i"] and len(ids[0]["i"]) == 12


@pytest.mark.parametrize("a,b,gated,boosted", [("martha", "marhta", 0.961111, 0.961111), ("abcdef", "abxyzw", 0.555556, 0.644444), ("", "x", 0.0, 0.0)])
def test_jaro_winkler(spark, a, b, gated, boosted):
    r = spark.createDataFrame([(a, b)], "a string, b string").select(F.round(P.name_similarity("a", "b"), 6).alias("g"), F.round(P.first_name_similarity("a", "b"), 6).alias("h")).first()
    assert (r["g"], r["h"]) == (gated, boosted)


def test_sound_codes(spark):
    v = ["Thompson", "Knight", "Philip", "Schmidt", "", None, "Looney"]
    m = column(spark, v, P.metaphone)
    assert m[0] == "0MSN" and m[1] == "NFT" or m[1].startswith("N")
    assert m[2] == "FLP" and m[4] == m[5] == "" and m[6] == "LN"
    n = column(spark, ["Looney", "MacDonald", "Knight", "", None], P.nysiis)
    assert n[0] == "LANY" and n[1] == "MCDANALD" and n[3] == n[4] == ""
