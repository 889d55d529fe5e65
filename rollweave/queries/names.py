"""Names, places, dates and codes over the record tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollweave.functions import parse, phonetic
from rollweave.functions import text as T
from rollweave.session import table


def name_normal_forms(spark: SparkSession, d: str) -> DataFrame:
    """Every normal form of a name and a unit."""
    r = table(spark, d, "results").select("pensioner_id", "pensioner_name", "regiment", "pensioner_last").distinct()
    return r.select("pensioner_id", T.normalise("pensioner_name").alias("letters"), T.fold_accents("pensioner_name").alias("folded"), T.trim_lower("pensioner_name").alias("lower_name"), T.words_lower("pensioner_name").alias("words"), T.plain_unit("regiment").alias("unit"), T.spouse_name("pensioner_last").alias("spouse_form"))


def name_splits(spark: SparkSession, d: str) -> DataFrame:
    """The three ways to split a whole name, and the listed form."""
    r = table(spark, d, "registry_vets").select("id", "name").distinct().where("name is not null")
    s = r.select("id", T.split_name("name").alias("a"), T.split_name("name", "first").alias("b"), T.split_name("name", "both").alias("c"), T.split_listed("name").alias("l"))
    return s.select("id", F.col("a.first").alias("first_a"), F.col("a.middle").alias("middle_a"), F.col("a.last").alias("last_a"), F.col("b.first").alias("first_b"), F.col("b.last").alias("last_b"), F.col("c.first").alias("first_c"), F.col("c.last").alias("last_c"), F.col("l.first").alias("listed_first"), F.col("l.last").alias("listed_last"))


def slug_names(spark: SparkSession, d: str) -> DataFrame:
    """Names read from memorial slugs."""
    m = table(spark, d, "memorial_cache").select("memorial_id", "slug").distinct()
    return m.select("memorial_id", T.slug_parts("slug").alias("p")).select("memorial_id", "p.first", "p.middle", "p.last").distinct()


def unit_places(spark: SparkSession, d: str) -> DataFrame:
    """State code and origin state of each typed regiment."""
    r = table(spark, d, "results").select("regiment").distinct()
    return r.select("regiment", T.unit_state("regiment").alias("state"), T.origin_state("regiment").alias("origin"))


def unit_search_phrases(spark: SparkSession, d: str) -> DataFrame:
    """Telling phrases of each regiment and the best of them."""
    r = table(spark, d, "results").select("regiment").where("trim(regiment) <> ''").distinct()
    return r.select("regiment", T.unit_phrases("regiment").alias("phrases")).select("regiment", F.array_join("phrases", "|").alias("phrases"), T.best_phrase("phrases").alias("best"))


def year_forms(spark: SparkSession, d: str) -> DataFrame:
    """The four readings of a typed date."""
    r = table(spark, d, "registry_vets").select("id", "born", "died").distinct()
    return r.select("id", "born", "died", T.year_anywhere("born").alias("anywhere"), T.year_leading("born").alias("leading"), T.year_word("born").alias("word"), F.size(T.years_all(F.concat_ws(" ", "born", "died"))).alias("n_years"))


def soundex_codes(spark: SparkSession, d: str) -> DataFrame:
    """Three Soundex codes of each surname."""
    r = table(spark, d, "registry_vets").select("last_name").distinct().where("last_name is not null")
    return r.select("last_name", phonetic.soundex("last_name").alias("sx_a"), phonetic.soundex_seeded(T.normalise("last_name")).alias("sx_b"), phonetic.soundex_sticky("last_name").alias("sx_c"))


def sound_codes(spark: SparkSession, d: str) -> DataFrame:
    """Metaphone and NYSIIS code of each surname."""
    r = table(spark, d, "registry_vets").select(F.lower("last_name").alias("last_name")).distinct().where("last_name is not null")
    return r.select("last_name", phonetic.metaphone("last_name").alias("metaphone"), phonetic.nysiis("last_name").alias("nysiis"))


def name_similarity(spark: SparkSession, d: str) -> DataFrame:
    """Two Jaro-Winkler similarities of the surnames of results and their registry copies."""
    r = table(spark, d, "results").select("pensioner_last", F.explode("cgr_records").alias("c")).select(F.col("pensioner_last").alias("a"), F.col("c.last_name").alias("b")).distinct().where("a is not null and b is not null")
    return r.select("a", "b", F.round(phonetic.name_similarity("a", "b"), 6).alias("gated"), F.round(phonetic.first_name_similarity("a", "b"), 6).alias("boosted"))


def nickname_variants(spark: SparkSession, d: str) -> DataFrame:
    """Nicknames and short forms of each given name."""
    r = table(spark, d, "results").select(F.trim("pensioner_first").alias("first")).distinct().where("first <> ''")
    return r.select("first", F.array_join(T.nickname_candidates("first"), "|").alias("nicknames"), F.array_join(T.short_forms("first"), "|").alias("forms"))


def label_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Memorial numbers and slugs inside label texts."""
    r = table(spark, d, "label_snapshots").select("ground_truth_memorial_id").distinct().where("ground_truth_memorial_id is not null")
    return r.select("ground_truth_memorial_id", F.array_join(T.memorial_numbers("ground_truth_memorial_id"), ",").alias("numbers"), T.slug_of_address("ground_truth_memorial_id").alias("slug"))


def memorial_pages(spark: SparkSession, d: str) -> DataFrame:
    """Name and years of the last cached page of each memorial."""
    m = table(spark, d, "memorial_cache").groupBy("memorial_id").agg(F.max(F.struct("cached_at", "html")).alias("r"))
    return m.select("memorial_id", parse.memorial_page("r.html").alias("p")).select("memorial_id", "p.name", "p.birth_year", "p.death_year")


STRATEGY, LOCATION = (rf'"{k}":\s*"([^"]+)"' for k in ("strategy", "locationId"))  # the first one named, in damaged payloads too


def payload_fields(spark: SparkSession, d: str) -> DataFrame:
    """The search strategy and location of each fetch, whole and damaged payloads alike."""
    o = table(spark, d, "observations").where("kind = 'FaGCandidateFetch'").select("observation_id", T.unwrapped_json("payload").alias("payload"))
    found = o.select("observation_id", F.regexp_extract("payload", STRATEGY, 1).alias("strategy"), F.regexp_extract("payload", LOCATION, 1).alias("location"))
    return found.where("strategy <> ''").distinct()


def unwrapped_sql(x: str) -> str:
    """SQL of ``text.unwrapped_json``."""
    return f"CASE WHEN ltrim({x}) LIKE '\"%' THEN coalesce(json_extract_string(try_cast({x} AS JSON), '$'), {x}) ELSE {x} END"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (name_normal_forms, name_splits, slug_names, unit_places, unit_search_phrases, year_forms, soundex_codes, sound_codes, name_similarity, nickname_variants, label_numbers, memorial_pages, payload_fields)}


def _letters(x: str) -> str:
    return f"regexp_replace(lower(coalesce({x}, '')), '[^a-z]', '', 'g')"


def fold_sql(x: str) -> str:
    return f"regexp_replace(translate(lower(coalesce({x}, '')), '{T.ACCENTED}', '{T.PLAIN}'), '[^a-z]', '', 'g')"


def _runs(x: str) -> str:
    for k in "0123456":
        x = f"regexp_replace({x}, '{k}+', '{k}', 'g')"
    return x


def soundex_sql(x: str) -> str:
    n = _letters(x)
    return f"CASE WHEN {n} = '' THEN '' ELSE substr(rpad(upper(substr({n}, 1, 1)) || replace({_runs(f"translate(substr({n}, 2), '{phonetic.LETTERS}', '{phonetic.DIGITS}')")}, '0', ''), 4, '0'), 1, 4) END"


def _more_sql() -> dict[str, str]:
    listed = lambda entries: "(VALUES " + ", ".join(f"('{k}', {v})" for k, v in entries.items()) + ") "
    relations = {k: v for k, v in T._relations().items() if v}
    n = "trim(regexp_replace(regexp_replace(lower(trim(first)), '[^a-z\\s]', '', 'g'), '\\s+', ' ', 'g'))"
    plain = " AND ".join(f"NOT contains(lower(h), '{u}')" for u in T.UNIT_WORDS)
    worth = "(CASE WHEN regexp_matches(p, '\\d') THEN 10 ELSE 0 END + CASE WHEN len(list_filter(regexp_split_to_array(p, '\\s+'), lambda w: regexp_matches(w, '^[A-Z]'))) >= 2 THEN 5 ELSE 0 END - CASE WHEN length(p) < 5 THEN 10 ELSE 0 END)"
    return {
        "payload_fields": f"SELECT DISTINCT observation_id, regexp_extract(p, '{STRATEGY}', 1) AS strategy, regexp_extract(p, '{LOCATION}', 1) AS location FROM (SELECT observation_id, {unwrapped_sql('payload')} AS p FROM observations WHERE kind = 'FaGCandidateFetch') WHERE regexp_extract(p, '{STRATEGY}', 1) <> ''",
        "nickname_variants": f"WITH r AS (SELECT DISTINCT trim(pensioner_first) AS first FROM results WHERE trim(pensioner_first) <> '') SELECT first, coalesce(array_to_string(a.v, '|'), '') AS nicknames, CASE WHEN b.v IS NULL THEN {n} ELSE {n} || '|' || array_to_string(b.v, '|') END AS forms FROM r LEFT JOIN {listed(relations)} a(k, v) ON a.k = lower(first) LEFT JOIN {listed(T.SHORT_FORMS)} b(k, v) ON b.k = {n}",
        "unit_search_phrases": f"""WITH r AS (SELECT DISTINCT regiment FROM results WHERE trim(regiment) <> ''), s AS (SELECT regiment, list_filter(list_transform(regexp_split_to_array(regiment, '(?i)\\s+(?:&|and)\\s+'), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') AS parts FROM r),
            q AS (SELECT regiment, list_transform(parts, lambda x: coalesce(list_extract(list_filter(list_transform(range(len(regexp_split_to_array(x, '\\s+')), 0, -1), lambda i: array_to_string(regexp_split_to_array(x, '\\s+')[1:i], ' ')), lambda h: {plain} AND (regexp_matches(h, '\\d') OR contains(h, ' '))), 1), x)) AS found FROM s),
            u AS (SELECT regiment, list_filter(found, lambda p, i: list_position(list_transform(found, lambda y: lower(y)), lower(p)) = i)[1:3] AS phrases FROM q), w AS (SELECT *, list_transform(phrases, lambda p: {worth}) AS worth FROM u)
            SELECT regiment, array_to_string(phrases, '|') AS phrases, coalesce(list_extract(phrases, list_position(worth, list_max(worth))), '') AS best FROM w""",
    }


def oracle_sql() -> dict[str, str]:
    w = "list_filter(regexp_split_to_array(trim(name), '\\s+'), lambda x: x <> '')"
    part = lambda i: f"coalesce(list_extract(w, {i}), '')"
    origin = "CASE " + " ".join(f"WHEN contains(lower(coalesce(regiment, '')), '{k}') THEN '{v}'" for k, v in T.ORIGIN_STATES.items()) + " END"
    up = "upper(regexp_replace(coalesce(regiment, ''), '\\bCo\\.', 'Co', 'g'))"
    named = "CASE " + " ".join(f"WHEN contains({up}, '{k}') THEN '{v}'" for k, v in T.STATE_NAMES.items()) + " ELSE '' END"
    codes = f"list_filter(regexp_extract_all({up}, '\\b({'|'.join(T.STATE_CODES)})\\b'), lambda x: x <> 'CO')"
    sx_b = f"CASE WHEN n = '' THEN '' ELSE substr(rpad(upper(substr(n, 1, 1)) || replace(substr({_runs(f"translate(n, '{phonetic.LETTERS}', '{phonetic.DIGITS}')")}, 2), '0', ''), 4, '0'), 1, 4) END"
    sx_c = f"CASE WHEN n = '' THEN '' ELSE substr(rpad(upper(substr(n, 1, 1)) || {_runs(f"replace(translate(substr(n, 2), '{phonetic.LETTERS}', '{phonetic.DIGITS}'), '0', '')")}, 4, '0'), 1, 4) END"
    spouse = "regexp_replace(lower(regexp_replace(trim(coalesce(pensioner_last, '')), '\\.+$', '')), '\\s+', ' ', 'g')"
    for s in ("sr", "jr", "ii", "iii", "iv"):
        spouse = f"regexp_replace({spouse}, ' {s}$', '')"
    return _more_sql() | {
        "name_normal_forms": f"""SELECT DISTINCT pensioner_id, {_letters('pensioner_name')} AS letters, {fold_sql('pensioner_name')} AS folded, lower(trim(coalesce(pensioner_name, ''))) AS lower_name,
            trim(regexp_replace(regexp_replace(lower(trim(coalesce(pensioner_name, ''))), '[^a-z\\s]', '', 'g'), '\\s+', ' ', 'g')) AS words,
            trim(regexp_replace(regexp_replace(lower(coalesce(regiment, '')), '[^a-z0-9\\s-]', ' ', 'g'), '\\s+', ' ', 'g')) AS unit, {spouse} AS spouse_form FROM results""",
        "name_splits": f"""WITH r AS (SELECT DISTINCT id, name, {w} AS w FROM registry_vets WHERE name IS NOT NULL),
            l AS (SELECT *, CASE WHEN contains(name, ',') THEN list_filter(regexp_split_to_array(trim(substr(name, strpos(name, ',') + 1)), '\\s+'), lambda x: x <> '') ELSE w END AS lw FROM r)
            SELECT id, CASE WHEN len(w) > 1 THEN {part(1)} ELSE '' END AS first_a, CASE WHEN len(w) > 2 THEN array_to_string(w[2:len(w)-1], ' ') ELSE '' END AS middle_a, {part(-1)} AS last_a,
            {part(1)} AS first_b, CASE WHEN len(w) > 1 THEN {part(-1)} ELSE '' END AS last_b, {part(1)} AS first_c, {part(-1)} AS last_c,
            coalesce(list_extract(lw, 1), '') AS listed_first, CASE WHEN contains(name, ',') THEN trim(substr(name, 1, strpos(name, ',') - 1)) ELSE '' END AS listed_last FROM l""",
        "slug_names": """WITH m AS (SELECT DISTINCT memorial_id, split_part(lower(coalesce(slug, '')), '/', 1) AS s FROM memorial_cache), p AS (SELECT *, string_split(s, '_') AS b, string_split(s, '-') AS h, list_extract(string_split(s, '_'), -1) AS e FROM m)
            SELECT DISTINCT memorial_id, CASE WHEN len(b) > 1 THEN b[1] ELSE h[1] END AS first,
            CASE WHEN len(b) > 1 AND contains(e, '-') THEN array_to_string(list_append(CASE WHEN len(b) > 2 THEN b[2:len(b)-1] ELSE [] END, split_part(e, '-', 1)), ' ') WHEN len(b) > 1 THEN array_to_string(b[2:], ' ') WHEN len(h) > 2 THEN array_to_string(h[2:len(h)-1], ' ') ELSE '' END AS middle,
            CASE WHEN len(b) > 1 AND contains(e, '-') THEN substr(e, strpos(e, '-') + 1) WHEN len(b) > 1 THEN e WHEN len(h) > 1 THEN list_extract(h, -1) ELSE '' END AS last FROM p""",
        "unit_places": f"SELECT DISTINCT regiment, coalesce(list_extract({codes}, 1), {named}) AS state, {origin} AS origin FROM results",
        "year_forms": """SELECT DISTINCT id, born, died, try_cast(regexp_extract(coalesce(born, ''), '(\\d{4})', 1) AS INTEGER) AS anywhere, try_cast(regexp_extract(coalesce(born, ''), '^\\s*(\\d{4})', 1) AS INTEGER) AS leading,
            try_cast(regexp_extract(coalesce(born, ''), '\\b(\\d{4})\\b', 1) AS INTEGER) AS word, len(regexp_extract_all(concat_ws(' ', born, died), '\\b(\\d{4})\\b')) AS n_years FROM registry_vets""",
        "soundex_codes": f"WITH r AS (SELECT DISTINCT last_name, {_letters('last_name')} AS n FROM registry_vets WHERE last_name IS NOT NULL) SELECT last_name, {soundex_sql('last_name')} AS sx_a, {sx_b} AS sx_b, {sx_c} AS sx_c FROM r",
        "name_similarity": f"""WITH r AS (SELECT DISTINCT pensioner_last AS a, c.last_name AS b FROM (SELECT pensioner_last, unnest(cgr_records) AS c FROM results) WHERE pensioner_last IS NOT NULL AND c.last_name IS NOT NULL),
            n AS (SELECT a, b, {_letters('a')} AS x, {_letters('b')} AS y, {fold_sql('a')} AS p, {fold_sql('b')} AS q FROM r),
            k AS (SELECT *, CASE WHEN substr(p,1,4) = substr(q,1,4) AND length(p) >= 4 AND length(q) >= 4 THEN 4 WHEN substr(p,1,3) = substr(q,1,3) AND length(p) >= 3 AND length(q) >= 3 THEN 3 WHEN substr(p,1,2) = substr(q,1,2) AND length(p) >= 2 AND length(q) >= 2 THEN 2 WHEN substr(p,1,1) = substr(q,1,1) AND p <> '' THEN 1 ELSE 0 END AS pre FROM n)
            SELECT a, b, round(CASE WHEN x = '' OR y = '' THEN 0 ELSE jaro_winkler_similarity(x, y) END, 6) AS gated,
            round(CASE WHEN p = '' AND q = '' THEN 1 WHEN p = '' OR q = '' THEN 0 ELSE jaro_similarity(p, q) + 0.1 * pre * (1 - jaro_similarity(p, q)) END, 6) AS boosted FROM k""",
        "label_numbers": """WITH g AS (SELECT DISTINCT ground_truth_memorial_id FROM label_snapshots WHERE ground_truth_memorial_id IS NOT NULL)
            SELECT ground_truth_memorial_id, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(ground_truth_memorial_id, '\\d+'), lambda x: length(x) BETWEEN 6 AND 9))), ',') AS numbers, regexp_extract(ground_truth_memorial_id, '(?i)memorial/\\d+/([^/?#"'']+)', 1) AS slug FROM g""",
        "memorial_pages": """WITH m AS (SELECT memorial_id, html, row_number() OVER (PARTITION BY memorial_id ORDER BY cached_at DESC, html DESC NULLS LAST) AS n FROM memorial_cache),
            p AS (SELECT memorial_id, coalesce(html, '') AS h FROM m WHERE n = 1), y AS (SELECT *, regexp_extract_all(regexp_replace(regexp_replace(h, '(?is)<h1[^>]*>.*?</h1>', ' ', 'g'), '<[^>]*>|&[a-zA-Z#0-9]+;', ' ', 'g'), '\\b(1[5-9]\\d\\d|20\\d\\d)\\b') AS ys FROM p)
            SELECT memorial_id, trim(regexp_replace(regexp_extract(h, '(?is)<h1[^>]*>(.*?)</h1>', 1), '\\s+', ' ', 'g')) AS name, list_extract(ys, 1) AS birth_year, list_extract(ys, 2) AS death_year FROM y""",
    }
