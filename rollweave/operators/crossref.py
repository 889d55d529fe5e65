"""Joins of records with other lists of the same persons: curated pairs, spouses, event evidence, links, pages, rosters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollweave.functions import text as T
from rollweave.functions.text import ColumnLike
from rollweave.operators.linkage import spouse_strength


def name_key(x: ColumnLike) -> Column:
    """A name part as it is looked up: trimmed, final dots dropped, upper case; '' for null."""
    return F.upper(F.regexp_replace(F.trim(T.text(x)), r"\.+$", ""))


def curated_matches(records: DataFrame, key: str, last: str, first: str, candidates: str, curated: DataFrame, top_n: int = 1, strict: bool = False) -> DataFrame:
    """``key, rank, id``: the best-ranked candidate of each record that a curated list has under the same surname and first initial.

    ``candidates`` is an array of structs with ``id`` (and ``slug``), best first; ``curated`` has ``last, first, id`` (and
    ``slug``). Only the first ``top_n`` candidates are tried, which is the feature. ``strict`` also wants equal slugs. Records or
    list rows without a surname or given name, null candidates and null ids match nothing; repeated rows count once.
    """
    slug = lambda x: F.regexp_replace(F.lower(F.trim(T.text(x))), "/+$", "")
    initial = lambda x: F.substring(name_key(x), 1, 1)
    tried = records.select(F.col(key), name_key(last).alias("_last"), initial(first).alias("_initial"), F.posexplode(F.slice(candidates, 1, top_n)).alias("_at", "_c"))
    extra = [slug("_c.slug").alias("_slug")] if strict else []
    tried = tried.where("_last <> '' and _initial <> '' and _c.id is not null").select(key, "_last", "_initial", (F.col("_at") + 1).alias("rank"), F.col("_c.id").alias("id"), *extra)
    kept = [slug("slug").alias("_slug")] if strict else []
    listed = curated.where("id is not null").select(name_key("last").alias("_last"), initial("first").alias("_initial"), "id", *kept).where("_last <> '' and _initial <> ''").distinct()
    hit = tried.join(listed, ["_last", "_initial", "id", *(["_slug"] if strict else [])])
    return hit.groupBy(key).agg(F.min(F.struct("rank", "id")).alias("_m")).select(key, "_m.rank", "_m.id")


def match_ranks(matches: DataFrame) -> DataFrame:
    """``rank, n``: how often the candidate of each rank was the one that matched."""
    return matches.groupBy("rank").agg(F.count(F.lit(1)).alias("n"))


def spouse_probe(records: DataFrame, key: str, first: ColumnLike, last: ColumnLike, candidates: str, found_first: str, found_last: str, top_n: int = 3, strict: bool = False) -> DataFrame:
    """``key, rank, strength, outcomes``: the first of the ``top_n`` candidates whose spouse is the known one, and what became of each.

    An outcome is ``no``, the strength of the match, or ``skipped`` after it. If none matched, the rank is 0 and the strength null;
    records without candidates give no row; null candidates match nothing. Nothing is shuffled.
    """
    strength = F.transform(F.slice(candidates, 1, top_n), lambda c: spouse_strength(first, last, c[found_first], c[found_last], strict))
    rows = records.where(F.size(candidates) > 0).select(key, strength.alias("_s"))
    at = F.array_position(F.transform("_s", lambda s: s.isNotNull()), True)
    rows = rows.withColumn("_at", F.when(at > 0, at))
    outcome = F.transform("_s", lambda s, i: F.when(F.col("_at").isNull() | (i + 1 < F.col("_at")), "no").when(i + 1 == F.col("_at"), s).otherwise("skipped"))
    return rows.select(key, F.coalesce(F.col("_at").cast("int"), F.lit(0)).alias("rank"), F.try_element_at("_s", F.col("_at").cast("int")).alias("strength"), outcome.alias("outcomes"))


def latest_payloads(log: DataFrame, key: str, kind: str, payload: str, order: list[str], kinds: dict[str, str]) -> DataFrame:
    """``key`` and a column per kind of event: the payload of the last event of that kind, null if there was none.

    ``kinds``: event kind -> column. Events of no record (key null or 0) count for nothing. One aggregation for all kinds,
    with map-side combine, so a key with many events is reduced before it is shuffled.
    """
    last = [F.max(F.when(F.col(kind) == k, F.struct(*order, payload))).getField(payload).alias(name) for k, name in kinds.items()]
    return log.where(F.col(kind).isin(list(kinds)) & F.coalesce(F.col(key) != 0, F.lit(False))).groupBy(key).agg(*last)


def enriched(rows: DataFrame, key: str, evidence: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``evidence``, a value that is there already kept, and ``enriched``, whether one was added."""
    new = [c for c in evidence.columns if c != key]
    side = evidence.select(key, *[F.col(c).alias(f"_new_{c}") for c in new])
    joined = rows.join(side, key, "left")
    own = lambda c: F.col(c) if c in rows.columns else F.lit(None)
    added = reduce(lambda a, b: a | b, [own(c).isNull() & F.col(f"_new_{c}").isNotNull() for c in new])
    return joined.select(*[c for c in rows.columns if c not in new], *[F.coalesce(own(c), F.col(f"_new_{c}")).alias(c) for c in new], added.alias("enriched"))


def backfilled_links(rows: DataFrame, key: str, link: str, source: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with blank links filled from the first row of each key in ``source``, and ``outcome``: filled, skipped or missing."""
    first = source.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*order, T.text(link).alias("_found"))).alias("_m")).select(key, "_m._found")
    has, finds = T.text(link) != "", F.coalesce(F.col("_found"), F.lit("")) != ""
    joined = rows.join(first, key, "left")
    outcome = F.when(has, "skipped").when(finds, "filled").otherwise("missing")
    filled = F.when(has, F.col(link)).otherwise(F.coalesce("_found", F.lit("")))
    return joined.select(*[filled.alias(c) if c == link else F.col(c) for c in rows.columns], outcome.alias("outcome"))


def image_id(address: ColumnLike) -> Column:
    """The card number in an image address ``.../pensioncard:123/...``; null if there is none."""
    return F.nullif(F.regexp_extract(T.text(address), r"/pensioncard:(\d+)/", 1), F.lit("")).cast("long")


def page_ids(answer: ColumnLike, card: ColumnLike) -> Column:
    """The page numbers in an item's JSON, or the card's own for one that is not compound; [] without an answer."""
    c = T._c(answer)
    pages = F.from_json(F.get_json_object(c, "$.objectInfo.page"), "array<struct<pageptr string>>")
    numbers = F.filter(F.transform(pages, lambda p: p["pageptr"].try_cast("long")), lambda n: n.isNotNull())
    return F.when(c.isNull(), F.array().cast("array<bigint>")).when(F.size(numbers) > 0, numbers).otherwise(F.array(T._c(card).cast("long")))


def with_pages(rows: DataFrame, key: str, address: str, sidecar: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``pages`` and where they are from: the sidecar (``key, pages``), else derived from the image address, else none."""
    derived = image_id(address)
    joined = rows.withColumn("_side", F.lit(None).cast("array<bigint>")) if sidecar is None else rows.join(sidecar.select(key, F.col("pages").alias("_side")), key, "left")
    has = F.coalesce(F.size("_side") > 0, F.lit(False))
    pages = F.when(has, F.col("_side")).when(derived.isNotNull(), F.array(derived))
    return joined.select(*rows.columns, pages.alias("pages"), F.when(has, "sidecar").when(derived.isNotNull(), "derived").otherwise("none").alias("pages_from"))


def direct_links(links: DataFrame, key: str, linked: Column, candidates: DataFrame, candidate: Column) -> DataFrame:
    """``key, candidate_id, confidence``: a record that names a candidate's own number is that candidate, for certain."""
    left = links.select(F.col(key), linked.alias("candidate_id")).where("candidate_id <> ''").distinct()
    right = candidates.select(candidate.alias("candidate_id")).where("candidate_id <> ''").distinct()
    return left.join(right, "candidate_id").select(key, "candidate_id", F.lit(1.0).alias("confidence"))


def first_name_strength(a: ColumnLike, b: ColumnLike, whole_a: ColumnLike, whole_b: ColumnLike) -> Column:
    """``strong`` for equal given names or one that the other's whole name quotes; ``loose`` for three equal letters or an initial; null otherwise."""
    x, y = F.upper(F.trim(T.text(a))), F.upper(F.trim(T.text(b)))
    quoted = lambda whole: F.transform(F.regexp_extract_all(T.text(whole), F.lit('"([^"]+)"'), 1), F.upper)
    strong = (x == y) | F.array_contains(quoted(whole_a), y) | F.array_contains(quoted(whole_b), x)
    three = (F.length(x) >= 3) & (F.length(y) >= 3) & (F.substring(x, 1, 3) == F.substring(y, 1, 3))
    initial = (F.substring(x, 1, 1) == F.substring(y, 1, 1)) & ((F.length(x) == 1) | (F.length(y) == 1))
    return F.when((x == "") | (y == ""), None).when(strong, "strong").when(three | initial, "loose")


def widow_verdict(spouse_first: ColumnLike, spouse_last: ColumnLike, spouse_whole: ColumnLike, widow_first: ColumnLike, widow_last: ColumnLike, widow_whole: ColumnLike, husband: ColumnLike, soldier_last: ColumnLike) -> Column:
    """``strong``, ``loose`` or null: whether a spouse entry and a widow's record are one, given the husband's name on the record."""
    up = lambda x: F.upper(F.trim(T.text(x)))
    last, first = up(spouse_last), first_name_strength(spouse_first, widow_first, spouse_whole, widow_whole)
    there = (last != "") & (last == up(widow_last)) & first.isNotNull()
    named = (up(soldier_last) != "") & F.contains(up(husband), up(soldier_last))
    return F.when(~there, None).when(up(husband) == "", "loose").when(named & (first == "strong"), "strong").when(named, "loose")


def name_evidence(first_a: ColumnLike, middle_a: ColumnLike, last_a: ColumnLike, first_b: ColumnLike, middle_b: ColumnLike, last_b: ColumnLike) -> Column:
    """0 to 1 for two names: 0.5 for equal surnames (0.25 if one holds the other), 0.35 for equal given names (0.3 if their short forms meet), 0.05 for the middle initial."""
    la, lb, fa, fb = (T.words_lower(x) for x in (last_a, last_b, first_a, first_b))
    both = lambda x, y: (x != "") & (y != "")
    last = F.when(la == lb, 0.5).when(both(la, lb) & (F.contains(la, lb) | F.contains(lb, la)), 0.25).otherwise(0.0)
    first = F.when(fa == fb, 0.35).when(both(fa, fb) & F.arrays_overlap(T.short_forms(first_a), T.short_forms(first_b)), 0.3).otherwise(0.0)
    ma, mb = (F.upper(F.substring(F.trim(T.text(x)), 1, 1)) for x in (middle_a, middle_b))
    return F.least(last + first + F.when(both(ma, mb) & (ma == mb), 0.05).otherwise(0.0), F.lit(1.0))


# fixed values: what follows a state code in a unit's name
ROSTER_UNITS = "Infantry|Cavalry|Cav|Regiment|Rgmt|Battalion|Batn|Artillery|Arty"


def roster_state(unit: ColumnLike) -> Column:
    """The two letters before the kind of unit; ''."""
    return F.regexp_extract(T.text(unit), rf"(?i)\b([A-Z]{{2}})\b\s+(?:{ROSTER_UNITS})\b", 1)


def roster_join(records: DataFrame, key: str, last: str, first: str, unit: str, roster: DataFrame) -> DataFrame:
    """``key, verdict``: matched, no name, no roster entry or other state, by surname, first initial and, where known, the unit's state.

    ``roster`` has ``last, first, state``. It is reduced to one row per surname and initial before the join, with its states,
    of which there are few, so hot surnames cost no more than others.
    """
    of = lambda l, f: (T.normalise(l).alias("_last"), F.substring(T.normalise(F.regexp_replace(T.text(f), r"\.", "")), 1, 1).alias("_initial"))
    index = roster.select(*of("last", "first"), "state").where("_last <> '' and _initial <> ''").groupBy("_last", "_initial").agg(F.collect_set("state").alias("_states"))
    local = records.select(key, *of(last, first), roster_state(unit).alias("_state")).join(index, ["_last", "_initial"], "left")
    verdict = F.when((F.col("_last") == "") | (F.col("_initial") == ""), "no name").when(F.col("_states").isNull(), "no roster entry").when((F.col("_state") == "") | F.array_contains("_states", F.col("_state")), "matched").otherwise("other state")
    return local.select(key, verdict.alias("verdict"))


def top_counts(rows: DataFrame, value: Column, n: int = 10) -> DataFrame:
    """``value, n`` of the ``n`` most frequent values, ties in order of the value. Only that many rows are ever sorted."""
    return rows.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(n)


def evaluation(predicted: DataFrame, truth: DataFrame, key: str, status: str, decision: str) -> DataFrame:
    """One row: how decisions agree with labels. Records without a label count as right; others if accepted ones, and only they, were accepted."""
    t = predicted.join(truth.select(key, F.col(decision).alias("_t")), key, "left")
    auto, yes, no = F.coalesce(F.col(status) == "auto_accept", F.lit(False)), F.col("_t") == "accepted", F.col("_t") == "rejected"
    right = F.col("_t").isNull() | (yes & auto) | (no & ~auto)
    count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    s = t.agg(F.count(F.lit(1)).alias("total"), count(right).alias("correct"), count(yes & auto).alias("tp"), count(no & auto).alias("fp"), count(yes & ~auto).alias("fn"))
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return s.select("total", "correct", share(F.col("correct"), F.col("total")).alias("accuracy"), share(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), share(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"))


def slug_shape(slug: ColumnLike) -> Column:
    """``parts, hyphenated``: words of a slug between underscores, and whether the last one has a hyphen."""
    parts = F.split(F.element_at(F.split(T.text(slug), "/"), 1), "_")
    return F.struct(F.size(parts).alias("parts"), F.element_at(parts, -1).contains("-").alias("hyphenated"))


# fixed values: given names that are abbreviations of others
ABBREVIATED = ["wm", "wms", "will", "jas", "jno", "thos", "chas", "geo", "rob", "robt", "saml", "benj", "danl"]


def ladder_hits(first: ColumnLike, middle: ColumnLike, last: ColumnLike, birth: ColumnLike, death: ColumnLike, unit: ColumnLike, slug: ColumnLike) -> dict[str, Column]:
    """Which search strategy would find the memorial with this slug for a person, in the order in which they are tried."""
    s = T.slug_parts(slug)
    f, m, l = (T.normalise(x) for x in (first, middle, last))
    sf, sm, sl = (T.normalise(s.getField(x)) for x in ("first", "middle", "last"))
    head = lambda a, b: (a != "") & (b != "") & (F.substring(a, 1, 1) == F.substring(b, 1, 1))
    born, died = T.year_anywhere(birth), T.text(death)
    died = F.when(F.trim(died).rlike(r"^\d+$"), F.trim(died).try_cast("int"))
    plausible = lambda y: F.coalesce((y > 1700) & (y < 2100), F.lit(False))
    return {
        "exact": (f != "") & (sf == f) & ((m == "") | (sm == m) | head(sm, m)) & (sl == l),
        "first initial, exact": (F.length(f) == 1) & head(f, sf),
        "middle initial": head(m, sm),
        "first initial, surname": (l != "") & (sl == l) & head(f, sf),
        "surname": (l != "") & (sl == l),
        "war context": (T.text(unit) != "") | plausible(born),
        "home": F.coalesce(died.between(1910, 1940), F.lit(False)),
        "unit state": F.coalesce(T.text(unit).rlike(r"\b[A-Z]{2}\b"), F.lit(False)),
        "abbreviation": f.isin(ABBREVIATED),
        "apostrophe": F.contains(T.text(last), F.lit("'")) | F.contains(T.text(slug), F.lit("'")),
    }
