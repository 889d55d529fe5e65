"""Comparable features of records about persons, and the evidence that two records name the same one.

Features are read from typed fields in one Arrow pass; the comparison itself is a column expression.
Each agreeing attribute counts the bits by which it is rarer in chance pairs, fixed for each kind of attribute; against
them stand the rows that carry the name anyway, and how seldom a surname is misspelt that far. The size of the table
as such counts for nothing; a contradiction in any attribute rules the pair out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, partial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollweave.llm.canonical import LIST_BOUND, STATES, Gazetteer, _gazetteer
from rollweave.llm.edits import fold, within

# fixed values: given names with the short forms, abbreviations and nicknames in use
GIVEN = {
    "abraham": "abe abram abrm bram", "albert": "al albt bert", "alexander": "alec alex alexr aleck sandy eck", "alfred": "alf alfd al fred", "andrew": "andw andy drew andr", "augustus": "aug augs gus gussie", "bartholomew": "bart barth bat",
    "benjamin": "ben benj benny bennie", "calvin": "cal calv", "charles": "charley charlie chas chuck", "christopher": "chris christr kit xpher", "cornelius": "con corn neil neely", "daniel": "dan danl danny", "david": "dave davd davy", "edward": "ed edw edwd eddie ned ted",
    "elijah": "eli elij lige lee", "elisha": "elis lish eli", "ezekiel": "ezek zeke", "francis": "fr fran fras frank franky", "frederick": "fred fredk freddy", "gabriel": "gabe gabl", "george": "geo georgie", "harrison": "hal harn harry", "henry": "hal hank harry hy hen",
    "hezekiah": "hez hezk ki", "isaac": "ike isc zac", "jacob": "jac jacb jake", "james": "jas jem jim jimmy jamie", "jefferson": "jeff jefn", "jeremiah": "jem jere jerry", "jesse": "jess", "john": "jack jno johnny jon", "jonathan": "jon jona nathan nat", "joseph": "joe jos joey",
    "joshua": "josh", "josiah": "josh jos si", "lawrence": "larry lawr lon", "lemuel": "lem leml", "leonidas": "lee leo leon lon", "lewis": "lew louis", "marcus": "marc mark", "matthew": "mat matt matty", "michael": "mich michl mick mickey mike", "moses": "mos mose", "nathaniel": "nat nate nathan nathl nath than",
    "oliver": "olivr ollie noll", "patrick": "paddy pat patk", "peter": "pete petr", "philip": "phil phill pip", "reuben": "reub rube", "richard": "dick rich richd rick", "robert": "bob bobby rob robt robin", "samuel": "sam saml sammy", "silas": "si", "simon": "si sim", "solomon": "sol soln", "stephen": "steph stepn steve",
    "sylvester": "sly sy syl sylv vess vester", "theodore": "dora ted teddy theo", "thomas": "thos tom tommy", "timothy": "tim timy", "tobias": "tob toby", "valentine": "val valn", "walter": "walt waltr wat", "william": "bill billy will willie wm", "zachariah": "zach zack",
}
TITLES = set("mr mrs ms miss dr rev sgt sergt capt col gen lt lieut pvt cpl maj hon prof private sergeant captain corporal soldier veteran sic dec deceased sr jr esq ii iii iv".split())
PREFIXES = set("van von de del der la le mc mac o st".split())
UNNAMED = set("unknown various misc miscellaneous unnamed unidentified catch catchall general index card cards see box none several sundry illegible blank unassigned na test".split())


@lru_cache(maxsize=1)
def _given_forms() -> tuple[dict[str, tuple[str, ...]], dict[int, list[str]]]:
    forms: dict[str, set[str]] = {}
    for formal, short in GIVEN.items():
        for f in (formal, *short.split()):
            forms.setdefault(f, set()).add(formal)
    by_length: dict[int, list[str]] = {}
    for f in GIVEN:
        by_length.setdefault(len(f), []).append(f)
    return {f: tuple(sorted(x)) for f, x in forms.items()}, by_length


@lru_cache(maxsize=200_000)
def given_names(token: str) -> tuple[str, ...]:
    """The given names a typed token can stand for, misspellings by one edit (two in long names) included; () if none."""
    forms, by_length = _given_forms()
    t = re.sub("[^a-z]", "", token.replace("0", "o").replace("1", "l"))
    if t in forms:
        return forms[t]
    if len(t) < 4:
        return ()
    t = t.replace("rn", "m") if t.replace("rn", "m") in forms else t
    if t in forms:
        return forms[t]
    most = 1 if len(t) < 8 else 2
    best = min(((within(t, x, most), x) for n in range(len(t) - most, len(t) + most + 1) for x in by_length.get(n, ())), default=(9, ""))
    return (best[1],) if best[0] <= most else ()


def parse_name(text: str | None) -> list[tuple[str, list[str]]]:
    """The ``(surname, other parts)`` that a typed name can be read as, all lower case without accents; none if it names nobody.

    Titles, suffixes and bracketed remarks are dropped, ``Last, First Middle`` and ``Last First M.`` are
    turned round, and surname prefixes are joined to the surname. Where it can't be told which end is the
    surname, both readings are given.
    """
    t = re.sub(r"\([^)]*\)|\[[^\]]*\]", " ", fold(text or ""))
    t = re.sub(r"(?<=[a-z])0(?=[a-z])", "o", t).replace("’", "'")
    head, comma, tail = t.partition(",")
    split = lambda s: [w for w in re.findall(r"[a-z0-9'\-]+", s) if w.strip("'-0123456789") and w.strip("'-.") not in TITLES]
    first, rest = split(head), split(tail)
    if any(w in UNNAMED for w in first + rest):
        return []
    clean = lambda surname, others: (re.sub("[^a-z]", "", "".join(surname)), [x for x in (re.sub("[^a-z]", "", w) for w in others) if x])
    if comma and rest:
        return [clean(first, rest)]
    words = first or rest
    if not words:
        return []
    at = len(words) - 1
    while at > 0 and words[at - 1].strip("'") in PREFIXES and (at > 1 or len(words) == 2):
        at -= 1
    usual = clean(words[at:], words[:at])
    k = 0
    while k < len(words) - 2 and words[k].strip("'") in PREFIXES:
        k += 1
    turned = clean(words[: k + 1], words[k + 1 :])
    last, begin = words[-1].replace("'", ""), words[0].strip("'")
    if len(words) < 2 or len(begin) == 1 or given_names(begin):
        # a long word before the last that is no given name may be half of a double surname
        double = len(words) - at == 1 and at > 1 and len(words[at - 1]) > 7 and not given_names(words[at - 1])
        return [usual, clean(words[at - 1 :], words[: at - 1])] if double else [usual]
    if len(last) == 1 or len(last) < 9 and given_names(last):
        return [turned]
    return [usual, turned]


def first_year(text: str | None) -> int | None:
    """The first plausible year of a typed date."""
    m = re.search(r"(?<!\d)(1[5-9]\d\d|20\d\d)(?!\d)", text or "")
    return int(m[0]) if m else None


def company_letters(text: str | None) -> list[str]:
    """The company letters of a typed company: ``Co. B & I`` is b and i."""
    t = re.sub(r"<[^>]*>|\bco(?:mpany)?\b\.?", " ", fold(text or ""))
    return sorted(set(re.findall(r"\b[a-z]\b", t)))


def unit_keys(gazetteer: Gazetteer, text: str | None) -> list[int]:
    """Comparable keys of the units a value names: state and number where the list has such a unit, so that a short form without a branch compares too; for units without a number their id. Units off the list say nothing."""
    if not text or not text.strip():
        return []
    keys, part = set(), []
    for t in (*gazetteer.spread(gazetteer.tokens(text)), "and"):
        if t != "and":
            part.append(t)
            continue
        states, numbers = [x for x in part if x in STATE_NUMBER], [x for x in part if x.isdigit()]
        if len(states) == 1 and len(numbers) == 1 and len(numbers[0]) < 4:
            if (states[0], int(numbers[0])) in gazetteer.numbered:
                keys.add(STATE_NUMBER[states[0]] * 1000 + int(numbers[0]))
        part = []
    if not keys:
        for i in gazetteer.mentions(text):
            state, number = gazetteer.place[i]
            keys.add(STATE_NUMBER[state] * 1000 + number if state and number is not None else 1_000_000 + i)
    return sorted(keys)


STATE_NUMBER = {s: i for i, s in enumerate(sorted(STATES), 1)}
FEATURES = "id long, kind string, surname string, given array<string>, gi string, middle array<string>, mi string, birth int, death int, units array<long>, companies array<string>"


def person_features(rows: DataFrame, regiments: DataFrame) -> DataFrame:
    """A row of features per row of ``id, kind, name, birth, death, unit, company`` (repeated rows count once).

    Rows that name nobody (blank names, catch-all cards) and rows with a null id are left out: they can be
    linked to nothing. Absent attributes are '' or null or empty arrays.
    """
    listed = [tuple(r) for r in regiments.select("regiment_id", "canonical_name", "state", "unit_number", "branch", "aka").where("canonical_name is not null").limit(LIST_BOUND + 1).collect()]
    if len(listed) > LIST_BOUND:
        raise ValueError(f"the canonical list has more than {LIST_BOUND} entries")
    entries = tuple(sorted(set(listed), key=lambda r: r[0]))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        units_of = lru_cache(maxsize=100_000)(partial(unit_keys, _gazetteer(entries)))
        for batch in batches:
            out = []
            for key, kind, name, birth, death, unit, company in batch.itertuples(index=False):
                for surname, others in parse_name(name):
                    if not surname:
                        continue
                    parts = []
                    for words in (others[:1], others[1:]):  # the first name, and all others
                        names = sorted({n for w in words if len(w) > 1 for n in given_names(w) or (w,)})
                        parts += [names, "".join(sorted({n[0] for n in names} | {w for w in words if len(w) == 1}))]
                    out.append((key, kind, surname, *parts, first_year(birth), first_year(death), units_of(unit), company_letters(company)))
            frame = pd.DataFrame(out, columns=["id", "kind", "surname", "given", "gi", "middle", "mi", "birth", "death", "units", "companies"])
            frame["birth"], frame["death"] = frame["birth"].astype("Int32"), frame["death"].astype("Int32")
            yield frame

    return rows.select(F.col("id").cast("long"), "kind", "name", "birth", "death", "unit", "company").where("id is not null").distinct().mapInPandas(read, FEATURES)


def with_rarity(features: DataFrame) -> DataFrame:
    """The features with ``block``, the rows that carry the surname, and ``total``, all rows."""
    counts = features.groupBy("surname").agg(F.count(F.lit(1)).alias("block"))
    total = features.agg(F.count(F.lit(1)).alias("total"))
    return features.join(counts, "surname").crossJoin(F.broadcast(total))


INITIALS = {"given": "gi", "middle": "mi"}
# fixed values: shares of rows whose surname is a variant of another one at 1, 2 and 3 edits (all pairs of rows of check_l)
NEAR = (1 / 2400, 1 / 1700, 1 / 1065)
# fixed values: bits by which surnames of one person are less often 0, 1, 2 and 3 edits apart than equal (shares among linked rows of check_l)
SPELT = (0.0, 0.5, 1.5, 4.0)
# fixed values: bits of years that are equal, one and two apart, from their shares among rows of check_l with the same whole name, less those of years far apart
YEARS = (5.3, 2.3, -2.0)


def agreement() -> Column:
    """Bits of what the rows ``a`` and ``b`` agree in besides the surname; null if an attribute contradicts it. Years may differ by two."""
    c = lambda x: F.col(x)
    no = F.lit(None).cast("double")

    def part(x: str, y: str, full: float, initial: float) -> Column:
        """Bits of two name parts, each a list of names it can stand for, or an initial; null if they differ."""
        gx, gy, ix, iy = c(f"a.{x}"), c(f"b.{y}"), c(f"a.{INITIALS[x]}"), c(f"b.{INITIALS[y]}")
        near = F.exists(gx, lambda g: F.exists(gy, lambda h: F.when(F.substring(g, 1, 1) == F.substring(h, 1, 1), (F.levenshtein(g, h) <= 1) | (F.length(g) > 3) & (F.levenshtein(g, h) <= 2)).otherwise((F.length(g) > 3) & (F.levenshtein(g, h) <= F.when(F.length(g) > 5, 2).otherwise(1)))))
        return (
            F.when((ix == "") | (iy == ""), 0.0)
            .when((F.size(gx) > 0) & (F.size(gy) > 0), F.when(F.arrays_overlap(gx, gy), full).when(near, full - 1).otherwise(no))
            .otherwise(F.when(F.exists(F.split(ix, ""), lambda i: (i != "") & F.contains(iy, i)), initial).otherwise(no))
        )

    straight = part("given", "given", 4.5, 3.0) + part("middle", "middle", 5.5, 3.5)
    over, back = part("given", "middle", 5.0, 3.0), part("middle", "given", 5.0, 3.0)
    crossed = F.when((over > 0) | (back > 0), over + back - 2.5)  # first and middle name changed places
    names = F.coalesce(straight, crossed)

    def years(x: str) -> Column:
        gap = F.abs(c(f"a.{x}") - c(f"b.{x}"))
        return F.when(gap.isNull(), 0.0).when(gap == 0, YEARS[0]).when(gap == 1, YEARS[1]).when(gap == 2, YEARS[2]).otherwise(no)

    def sets(x: str, worth: float) -> Column:
        return F.when((F.size(c(f"a.{x}")) == 0) | (F.size(c(f"b.{x}")) == 0), 0.0).when(F.arrays_overlap(c(f"a.{x}"), c(f"b.{x}")), worth).otherwise(no)

    return names + years("birth") + years("death") + sets("units", 7.0) + sets("companies", 3.0)


def evidence(distance: Column) -> Column:
    """Bits beyond chance for the pair of rows ``a`` and ``b`` being one person; null if an attribute contradicts it.

    Chance are the rows expected in the pair's own name block: those with the surname and, if the surnames differ, those
    as near to it. ``distance``: edit distance of the surnames.
    """
    share = F.when(distance == 0, 0.0).when(distance == 1, NEAR[0]).when(distance == 2, NEAR[1]).otherwise(NEAR[2])
    spelt = F.when(distance == 0, SPELT[0]).when(distance == 1, SPELT[1]).when(distance == 2, SPELT[2]).otherwise(SPELT[3])
    return agreement() - spelt - F.log2(F.greatest("a.block", "b.block") + F.col("a.total") * share)


def results_people(results: DataFrame) -> DataFrame:
    """The persons of a results table, as ``person_features`` takes them."""
    return results.select(F.col("pensioner_id").alias("id"), F.lit("p").alias("kind"), F.coalesce(F.nullif(F.trim("pensioner_name"), F.lit("")), F.concat_ws(" ", "pensioner_first", "pensioner_middle", "pensioner_last")).alias("name"), F.col("pensioner_birth_year").alias("birth"), F.col("pensioner_death_year").alias("death"), F.col("regiment").alias("unit"), "company")


def gravestone_people(exports: DataFrame) -> DataFrame:
    """The persons of an exported linked-data table."""
    return exports.select(F.col("export_id").alias("id"), F.lit("p").alias("kind"), F.coalesce(F.nullif(F.trim("dcterms_title"), F.lit("")), F.concat_ws(" ", "schema_givenname", "schema_additionalname", "schema_familyname")).alias("name"), F.col("schema_birthdate").alias("birth"), F.col("schema_deathdate").alias("death"), F.col("schema_regiment").alias("unit"), F.col("schema_company").alias("company"))


def registry_people(vets: DataFrame) -> DataFrame:
    """The persons of a flat cemetery registry."""
    return vets.select(F.col("id"), F.lit("c").alias("kind"), F.coalesce(F.nullif(F.trim("name"), F.lit("")), F.concat_ws(" ", "first_name", "middle_name", "last_name")).alias("name"), F.col("born").alias("birth"), F.col("died").alias("death"), "unit", "company")
