"""Text and HTML parsing as column expressions and table functions."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from rollweave.functions import text as T
from rollweave.functions.text import ColumnLike

# fixed values: interface phrases that are no data, in the order of removal
INTERFACE_PHRASES = [
    "Flowers have been left.",
    "Flowers have been left",
    "Leave a flower",
    "Leave flowers",
    "Sponsored by",
    "Added by",
    "Created by",
    "Find a Grave",
    "Virtual Cemetery",
    "drag images here",
    "Photo added by",
    "ADVERTISEMENT",
]
# fixed values: words in a card that say that someone was a veteran
VETERAN_WORDS = "VETERAN|CSA|C\\.S\\.A\\.|Civil War|Confederate|United States Army"
# fixed values: endings of burial place names
PLACES = "National Cemetery|Memorial Cemetery|Church Cemetery|City Cemetery|Cemetery|Burying Ground|Memorial Park|Memorial Gardens|Mausoleum|Graveyard"


def parse_card(card: ColumnLike) -> Column:
    """``name, is_veteran, birth_year, death_year, state, cemetery`` of the text of a search-result card."""
    c = T.strip_phrases(F.regexp_replace(T.text(card), r"\s+", " "), INTERFACE_PHRASES)
    span = r"(\d{4})\s*[–-]\s*(\d{4})"
    ranged = c.rlike(span)
    single = lambda form: F.nullif(F.regexp_extract(c, form, 1), F.lit(""))
    birth = F.when(ranged, F.regexp_extract(c, span, 1)).otherwise(single(r"(\d{4})\s*[–-]"))
    death = F.when(ranged, F.regexp_extract(c, span, 2)).otherwise(single(r"[–-]\s*(?:\d{1,2}\s+\w+\s+)?(\d{4})"))
    tokens = F.reverse(F.split(c, r",\s*"))
    names = F.create_map(*[F.lit(x) for k, v in T.STATE_NAMES.items() for x in (k.lower(), v)])
    of = lambda t: F.coalesce(F.try_element_at(names, F.lower(F.regexp_replace(F.trim(t), r"\.$", ""))), F.when(F.trim(t).rlike("^[A-Z]{2}$"), F.trim(t)))
    by_comma = F.try_element_at(F.array_compact(F.transform(tokens, of)), F.lit(1))
    place = lambda n: F.length(c) - F.locate(n[::-1], F.reverse(F.lower(c))) - len(n) + 1
    spots = F.array(*[F.struct(F.when(F.locate(k.lower()[::-1], F.reverse(F.lower(c))) > 0, place(k.lower())).otherwise(-1).alias("at"), F.lit(-i).alias("i"), F.lit(v).alias("s")) for i, (k, v) in enumerate(T.STATE_NAMES.items())])
    last = F.array_max(spots)
    code = F.nullif(F.regexp_extract(c, r"\b([A-Z]{2})\b", 1), F.lit(""))
    cemetery = F.nullif(F.trim(F.regexp_extract(c, r"([A-Z][A-Za-z\.\s]+?(?:" + PLACES + r"))\s*[,\n]", 1)), F.lit(""))
    name = F.trim(F.regexp_replace(c, r"(?i)\s*V\s*Veteran\s*$", ""))
    return F.struct(name.alias("name"), c.rlike(VETERAN_WORDS).alias("is_veteran"), birth.alias("birth_year"), death.alias("death_year"), F.coalesce(by_comma, F.when(last["at"] >= 0, last["s"]), code).alias("state"), cemetery.alias("cemetery"))


def parse_snippet(snippet: ColumnLike) -> Column:
    """``birth_year, death_year, cemetery_text`` of a result snippet."""
    s, span = T.text(snippet), r"\b(\d{4})\s*[–-]\s*(\d{4})\b"
    pick = lambda form, g: F.nullif(F.regexp_extract(s, form, g), F.lit(""))
    return F.struct(F.coalesce(pick(r"\b(\d{4})\s*–\s*\?", 1), pick(span, 1)).alias("birth_year"), pick(span, 2).alias("death_year"), F.nullif(F.trim(F.regexp_extract(s, r"(?i)([^,]+(?:Cemetery|Memorial|Church|Burying)[^,]+(?:,\s*[^,]+){0,4})", 1)), F.lit("")).alias("cemetery_text"))


def classify_response(title: ColumnLike, body: ColumnLike, url: ColumnLike) -> Column:
    """``kind, cooldown`` of a page response, by markers in title, body and address, in this order."""
    t, b, u = T.text(title), F.lower(T.text(body)), F.lower(T.text(url))
    kind = (
        F.when(t.contains("Rate Limited") | t.contains("Error 1015"), "rate_limited")
        .when(t.contains("Attention Required") | t.contains("Access denied"), "blocked")
        .when(t.contains("Just a moment"), "challenge")
        .when(b.contains("error 1015") | b.contains("rate limited"), "rate_limited")
        .when(b.contains("just a moment"), "challenge")
        .when(b.contains("attention required"), "blocked")
        .when(u.contains("challenge") | u.contains("turnstile"), "challenge")
        .otherwise("normal")
    )
    wait = F.when(kind == "rate_limited", 120).when(kind == "blocked", 60).when(kind == "challenge", 30).otherwise(0)
    return F.struct(kind.alias("kind"), wait.alias("cooldown"))


def memorial_page(page: ColumnLike) -> Column:
    """``name, birth_year, death_year`` of a cached memorial page; '' and null where the page is empty."""
    p = T.text(page)
    years = F.regexp_extract_all(T.strip_markup(F.regexp_replace(p, r"(?is)<h1[^>]*>.*?</h1>", " ")), F.lit(r"\b(1[5-9]\d\d|20\d\d)\b"), 1)
    return F.struct(T.strip_markup(F.regexp_extract(p, r"(?is)<h1[^>]*>(.*?)</h1>", 1)).alias("name"), F.try_element_at(years, F.lit(1)).alias("birth_year"), F.try_element_at(years, F.lit(2)).alias("death_year"))


def _clean(fragment: str) -> str:
    return re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " ", fragment))).strip()


class TableRows:
    """A row per data row of every HTML table: its place and its cells' texts; header rows give none."""

    def eval(self, page: str) -> Iterator[tuple[int, list[str]]]:
        at = 0
        for row in re.findall(r"(?is)<tr[^>]*>(.*?)</tr>", page or ""):
            cells = [_clean(x) for x in re.findall(r"(?is)<td[^>]*>(.*?)</td>", row)]
            if cells:
                yield at, cells
                at += 1


class LabelValues:
    """A row per label of a detail page: label, how often it was seen before, and the text that follows it."""

    def eval(self, page: str) -> Iterator[tuple[str, int, str]]:
        seen: dict[str, int] = {}
        for label, value in re.findall(r"(?is)<(?:b|strong|th|dt|label)[^>]*>\s*([^<:]{1,60}?)\s*:?\s*</(?:b|strong|th|dt|label)>\s*:?\s*(.*?)(?=<(?:b|strong|th|dt|label|/tr|br|/p|/dl|/li|hr)\b|$)", page or ""):
            k = seen.get(label, 0)
            seen[label] = k + 1
            yield label, k, _clean(value)


class NoticeBlocks:
    """A row per block of a newspaper result page: id, address, title, date, ISO date, place, match position, thumbnail."""

    def eval(self, page: str) -> Iterator[tuple[str, str, str, str, str, str, str, str]]:
        from datetime import datetime

        for block in re.split(r'(?=<div id="\d+")', page or ""):
            ident = re.match(r'<div id="(\d+)"', block)
            if not ident:
                continue
            find = lambda form, g=1: (m[g] if (m := re.search(form, block, re.S)) else "")  # noqa: E731, B023
            date = re.search(r"((?:Mon|Tues|Wednes|Thurs|Fri|Satur|Sun)day), +([A-Z][a-z]+) (\d+), (\d{4})", block)
            iso = ""
            if date:
                try:
                    iso = datetime.strptime(f"{date[2]} {date[3]} {date[4]}", "%B %d %Y").strftime("%Y-%m-%d")
                except ValueError:
                    pass
            link = re.search(r'href="(/image/\d+/\?match=(\d+)[^"]*)"', block)
            yield (ident[1], html.unescape(link[1]) if link else "", _clean(find(r"<h2>([^<]+)</h2>")), date[0] if date else "", iso, _clean(find(r'aria-label="Location"[^>]*>(?:<[^>]+>)*([^<]+)</span>')), link[2] if link else "", find(r'<img[^>]+src="([^"]+)"'))


class SpouseSection:
    """The first spouse of a memorial page: display name, first, middle and last name, memorial number, slug, year of marriage."""

    def eval(self, page: str) -> Iterator[tuple[str, str, str, str, str, str, str]]:
        at = re.search(r"(?is)>\s*Spouses?\s*<(.*)", page or "")
        link = re.search(r'(?is)/memorial/(\d+)/([^"\'/?#]+)[^>]*>(.*?)</a>(.*)', at[1]) if at else None
        if not link:
            return
        shown = _clean(link[3])
        year = re.search(r"(?i)\(?m(?:arried|\.)\s*(\d{4})", _clean(link[4])[:200])
        words = re.sub(r"\b\d{4}\b.*$", "", shown).split()
        if words:
            yield shown, words[0], " ".join(words[1:-1]), words[-1], link[1], link[2], year[1] if year else ""


def register_parsers(spark: SparkSession) -> None:
    """The parsers as SQL table functions: table_rows, label_values, notice_blocks, spouse_section."""
    text = "id string, href string, title string, date string, iso_date string, location string, match_position string, thumbnail string"
    spark.udtf.register("table_rows", F.udtf(TableRows, returnType="place int, cells array<string>"))
    spark.udtf.register("label_values", F.udtf(LabelValues, returnType="label string, seen int, value string"))
    spark.udtf.register("notice_blocks", F.udtf(NoticeBlocks, returnType=text))
    spark.udtf.register("spouse_section", F.udtf(SpouseSection, returnType="display string, first string, middle string, last string, memorial_id string, slug string, marriage_year string"))
