"""Search plans as data: strategies that turn a person into query parameters, and the compiler of declarative templates.

A strategy is a nullable ``map<string,string>`` column; null means that it does not apply.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollweave.functions import text as T
from rollweave.functions.text import ColumnLike

Person = Mapping[str, Column]
Strategy = Callable[[Person], Column]


def person(first: ColumnLike, middle: ColumnLike, last: ColumnLike, birth: ColumnLike, death: ColumnLike, **extra: ColumnLike) -> dict[str, Column]:
    """The columns that strategies read; '0' and blank years count as unknown."""
    year = lambda y: F.when(F.trim(T.text(y)).isin("", "0"), "").otherwise(F.trim(T.text(y)))
    return {"first": T.text(first), "middle": T.text(middle), "last": T.text(last), "birth_year": year(birth), "death_year": year(death), **{k: T.text(v) for k, v in extra.items()}}


def params(applies: Column, **values: Column | str | None) -> Column:
    """A map of the values that are not null or '', where the strategy applies."""
    pairs = [F.struct(F.lit(k.replace("__", "-")).alias("k"), (F.lit(v) if isinstance(v, str) else v).cast("string").alias("v")) for k, v in values.items()]
    return F.when(applies, F.map_from_entries(F.filter(F.array(*pairs), lambda p: F.coalesce(p["v"], F.lit("")) != "")))


def _named(p: Person) -> Column:
    return (p["first"] != "") & (p["last"] != "")


def _if(c: Column, value: str) -> Column:
    return F.when(c, value)


def exact(p: Person) -> Column:
    return params(_named(p), firstname=p["first"], lastname=p["last"], exactspelling="true", middlename=p["middle"], birthyear=p["birth_year"], birthyearfilter=_if(p["birth_year"] != "", "1"))


def middle_initial(p: Person) -> Column:
    return params(_named(p) & (F.length(p["middle"]) == 1), firstname=p["first"], middlename=p["middle"], lastname=p["last"], exactspelling="true")


def first_initial_fuzzy(p: Person) -> Column:
    return params(_named(p), firstname=F.concat(F.substring(p["first"], 1, 1), F.lit("*")), lastname=p["last"], fuzzyNames="true", birthyearfilter="5")


def fuzzy_last(p: Person) -> Column:
    return params(p["last"] != "", lastname=p["last"], fuzzyNames="true", birthyearfilter="5", middlename=p["middle"])


def apostrophe(p: Person) -> Column:
    return params(_named(p) & p["last"].contains("'"), firstname=p["first"], lastname=F.replace(p["last"], F.lit("'"), F.lit("")), fuzzyNames="true")


def veteran_flag(p: Person) -> Column:
    return params(_named(p), firstname=p["first"], lastname=p["last"], isVeteran="true")


def birth_year(p: Person) -> Column:
    window = F.when(p["exact"].isin("true", "True", "1"), "exact").otherwise("5") if "exact" in p else F.lit("5")
    return params(_named(p) & (p["birth_year"] != ""), firstname=p["first"], lastname=p["last"], exactspelling="true", birthyear=p["birth_year"], birthyearfilter=window, middlename=p["middle"])


def death_year(p: Person) -> Column:
    y = p["death_year"].try_cast("int")
    return params(_named(p) & y.isNotNull(), firstname=p["first"], lastname=p["last"], deathyear=p["death_year"], deathyearfilter=F.when(y < 1930, "10").otherwise("5"), exactspelling="true")


def both_years(p: Person) -> Column:
    known = (p["birth_year"] != "") & (p["death_year"] != "")
    return params(_named(p) & known, firstname=p["first"], lastname=p["last"], exactspelling="true", birthyear=p["birth_year"], birthyearfilter="5", deathyear=p["death_year"], deathyearfilter="5", middlename=p["middle"])


def year_window(p: Person) -> Column:
    b, d = p["birth_year"] != "", p["death_year"] != ""
    return params(_named(p) & (b | d), firstname=p["first"], lastname=p["last"], fuzzyNames="true", birthyear=p["birth_year"], birthyearfilter=_if(b, "5"), deathyear=p["death_year"], deathyearfilter=_if(d, "5"), middlename=p["middle"])


def unit_text(p: Person) -> Column:
    best = T.best_phrase(T.unit_phrases(p.get("regiment", F.lit(""))))
    return params(_named(p) & (best != ""), firstname=p["first"], lastname=p["last"], bio=best, isVeteran="true")


def nickname(p: Person) -> Column:
    others = T.nickname_candidates(p["first"])
    maiden = F.trim(p.get("spouse_last_name", F.lit("")))
    by_nick = params(F.size(others) > 0, firstname=F.try_element_at(others, F.lit(1)), lastname=p["last"], includeNickname="true", exactspelling="true", middlename=p["middle"])
    by_maiden = params(maiden != "", firstname=p["first"], lastname=maiden, includeMaidenName="true", exactspelling="true")
    return F.when(_named(p), F.coalesce(by_nick, by_maiden))


def follow_up(p: Person) -> Column:
    whole = lambda y: F.when(y.rlike(r"^\d+$"), (y.try_cast("int") - 10).cast("string"))
    b, d = whole(p["birth_year"]), whole(p["death_year"])
    return params(p["last"] != "", lastname=p["last"], fuzzy="true", birthyear=b, birthyear_range=_if(b.isNotNull(), "20"), deathyear=d, deathyear_range=_if(d.isNotNull(), "20"))


LADDER: dict[str, Strategy] = {
    "B1-exact": exact,
    "B2-middle-initial": middle_initial,
    "B3-first-initial-fuzzy": first_initial_fuzzy,
    "B4-fuzzy-last": fuzzy_last,
    "B5-apostrophe": apostrophe,
    "C1-cw-context": veteran_flag,
    "F1a-birth-year": birth_year,
    "F1b-death-year": death_year,
    "F1c-year-sniper": both_years,
    "F1d-year-window": year_window,
    "F2-regiment-bio": unit_text,
    "F3-nickname": nickname,
    "F4-follow-up": follow_up,
}

# fixed values: the defaults of newspaper searches
ENTITY_TYPES, YEARS = "page,obituary,marriage,birth", (1840, 1930)


def notice_keyword(p: Person, kinds: str = ENTITY_TYPES, years: tuple[int, int] = YEARS) -> Column:
    whole = lambda y: F.when(y.rlike(r"^\d+$"), y.try_cast("int"))
    b, d = whole(p["birth_year"]), whole(p["death_year"])
    words = F.array_join(F.filter(F.array(p["first"], p["middle"], p["last"]), lambda w: w != ""), " ")
    begin = F.when(b.isNotNull(), F.greatest(b - 5, F.lit(years[0]))).when(d.isNotNull(), F.greatest(d - 30, F.lit(years[0]))).otherwise(years[0])
    end = F.when(b.isNotNull() & d.isNotNull(), F.least(d + 5, F.lit(years[1]))).when(b.isNotNull(), b + 30).when(d.isNotNull(), d + 5).otherwise(years[1])
    return params((p["first"] != "") | (p["last"] != ""), keyword=words, entity__types=kinds, sort="score-desc", date__start=begin.cast("string"), date__end=end.cast("string"))


def notice_last(p: Person, kinds: str = ENTITY_TYPES, years: tuple[int, int] = YEARS) -> Column:
    return params(p["last"] != "", keyword=p["last"], entity__types=kinds, sort="score-desc", date__start=str(years[0]), date__end=str(years[1]))


def notice_state(p: Person, kinds: str = ENTITY_TYPES, years: tuple[int, int] = YEARS) -> Column:
    state = p.get("state", F.lit(""))
    return params((p["last"] != "") & (state != ""), keyword=F.concat(p["last"], F.lit(" "), state), entity__types=kinds, sort="score-desc", date__start=str(years[0]), date__end=str(years[1]))


NOTICES: dict[str, Strategy] = {"N1-keyword": notice_keyword, "N2-last": notice_last, "N3-last-state": notice_state}


def run_ladder(df: DataFrame, key: str, p: Person, ladder: Mapping[str, Strategy] = LADDER, mode: str = "all") -> DataFrame:
    """``key, rung, strategy, params`` of the strategies that apply, or in mode ``first`` of the first one."""
    rungs = F.array(*[F.struct(F.lit(i).alias("rung"), F.lit(n).alias("strategy"), s(p).alias("params")) for i, (n, s) in enumerate(ladder.items())])
    fired = F.filter(rungs, lambda r: r["params"].isNotNull())
    chosen = F.slice(fired, 1, 1) if mode == "first" else fired
    return df.select(key, F.explode(chosen).alias("r")).select(key, "r.rung", "r.strategy", "r.params")


# -- declarative templates ---------------------------------------------------------------------------


def _substitute(value: str, p: Person) -> Column:
    """``{field}`` and ``{extra.key}`` replaced by columns; unknown ones by ''."""
    import re

    parts, at = [], 0
    for m in re.finditer(r"\{(\w+)(?:\.(\w+))?\}", value):
        parts += [F.lit(value[at : m.start()]), p.get(m[2] if m[1] == "extra" and m[2] else m[1], F.lit(""))]
        at = m.end()
    return F.concat(*parts, F.lit(value[at:]))


def _slice(v: Column, start: int, stop: int | None) -> Column:
    n = F.length(v)
    place = lambda i: F.lit(i) if i >= 0 else F.greatest(n + i, F.lit(0))
    a, b = place(start or 0), n if stop is None else place(stop)
    return F.substring(v, a + 1, F.greatest(b - a, F.lit(0)))


def _choice(cases: list[dict[str, Any]], p: Person) -> Column:
    out = F.lit("")
    for case in reversed(cases):
        met = F.lit(True)
        for k, v in case.get("when", {}).items():
            met = met & (p.get(k, F.lit("")) == str(v))
        out = F.when(met, str(case.get("then"))).otherwise(out)
    return out


TRANSFORMS: dict[str, Callable[[Column, list, Person], Column]] = {
    "replace": lambda v, a, p: F.replace(v, F.lit(a[0]), F.lit(a[1])),
    "slice": lambda v, a, p: _slice(v, a[0], a[1]),
    "format": lambda v, a, p: F.lpad(v.try_cast("bigint").cast("string"), int(a[0]), "0"),
    "upper": lambda v, a, p: F.upper(v),
    "lower": lambda v, a, p: F.lower(v),
    "choice": lambda v, a, p: _choice(a, p),
}


def _value(node: Any, p: Person) -> Column | None:
    if node is None:
        return None
    if isinstance(node, str):
        return _substitute(node, p)
    if isinstance(node, dict):
        if "transform" in node:
            if node["transform"] not in TRANSFORMS:
                raise ValueError(f"unknown transform {node['transform']!r}")
            given = node.get("input", "")
            return TRANSFORMS[node["transform"]](_substitute(given, p) if isinstance(given, str) else F.lit(str(given)), node.get("args", []), p)
        return _substitute(node["value"], p) if isinstance(node.get("value"), str) else F.lit(str(node["value"])) if "value" in node else None
    return F.lit(str(node))


def compile_template(spec: Mapping[str, Any]) -> Strategy:
    """A strategy from a declarative spec: ``applies_when`` fields, and ``params`` whose keys with a final ``?`` need a value."""

    def strategy(p: Person) -> Column:
        applies = F.lit(True)
        for f in spec.get("applies_when", []):
            applies = applies & (p.get(f, F.lit("")) != "")
        pairs = []
        for raw, node in spec.get("params", {}).items():
            v = _value(node, p)
            if v is not None:
                v = v.cast("string")
                pairs.append(F.struct(F.lit(raw.rstrip("?")).alias("k"), (F.when(v != "", v) if raw.endswith("?") else F.coalesce(v, F.lit(""))).alias("v")))
        return F.when(applies, F.map_from_entries(F.filter(F.array(*pairs), lambda x: x["v"].isNotNull())) if pairs else F.create_map().cast("map<string,string>"))

    return strategy


class StrategyRegistry:
    """Strategies by name; new ones are functions of a person or template specs."""

    def __init__(self, strategies: Mapping[str, Strategy] | None = None):
        self._known: dict[str, Strategy] = dict(LADDER if strategies is None else strategies)

    def register(self, name: str, strategy: Strategy | Mapping[str, Any]) -> None:
        self._known[name] = strategy if callable(strategy) else compile_template(strategy)

    def get(self, name: str) -> Strategy:
        if name not in self._known:
            raise KeyError(f"no strategy {name!r}; known: {', '.join(sorted(self._known))}")
        return self._known[name]

    def names(self) -> list[str]:
        return sorted(self._known)

    def ladder(self, *names: str) -> dict[str, Strategy]:
        return {n: self.get(n) for n in names or self._known}


# -- filters added to parameters -----------------------------------------------------------------------


def with_filters(p: Column, state_id: ColumnLike, country: Mapping[str, str], spouse: tuple[ColumnLike, ColumnLike, ColumnLike] | None = None, dates: bool = True, years: tuple[int, int] = (1810, 1955)) -> Column:
    """Parameters with the place (state, else country), the date window where no years are set, and the spouse's whole name."""
    put = lambda m, k, v, c: F.when(c, F.map_concat(F.map_filter(m, lambda x, _: x != k), F.create_map(F.lit(k), v))).otherwise(m)
    s = T.text(state_id)
    out = put(p, "locationId", s, s != "")
    for k, v in country.items():
        out = put(out, k, F.lit(v), s == "")
    if dates:
        for side, year, kind in (("birth", years[0], "after"), ("death", years[1], "before")):
            free = ~F.map_contains_key(p, f"{side}year")
            out = put(put(out, f"{side}year", F.lit(str(year)), free), f"{side}yearfilter", F.lit(kind), free)
    if spouse:
        f, m, l = (F.trim(T.text(x)) for x in spouse)
        whole = F.regexp_replace(F.array_join(F.filter(F.array(f, m, l), lambda w: w != ""), " "), r"\s+", " ")
        out = put(out, "linkedToName", whole, (f != "") & (l != "") & ~F.map_contains_key(p, "linkedToName"))
    return out


def query_string(p: ColumnLike) -> Column:
    """Parameters as an address query, keys in order, encoded as HTML forms do."""
    quoted = lambda v: F.regexp_replace(F.replace(F.url_encode(v), F.lit("*"), F.lit("%2A")), "%7E", "~")
    entries = F.array_sort(F.map_entries(T._c(p)))
    return F.array_join(F.transform(entries, lambda e: F.concat(quoted(e["key"]), F.lit("="), quoted(e["value"]))), "&")
