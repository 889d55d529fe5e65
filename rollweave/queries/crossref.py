"""Cross references: curated pairs, spouses, evidence, links, pages, rosters, evaluation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollweave.functions import text as T
from rollweave.operators import analytics, crossref
from rollweave.operators.references import number_key
from rollweave.queries.matching import _copies, _records, _records_sql
from rollweave.queries.names import oracle_sql as names_sql
from rollweave.session import table


def curated_matches(spark: SparkSession, d: str) -> DataFrame:
    """The first of three candidates of each record that the registry has under the same surname and initial."""
    curated = table(spark, d, "registry_vets").select(F.col("last_name").alias("last"), F.col("first_name").alias("first"), "id")
    found = crossref.curated_matches(_records(spark, d), "pensioner_id", "pensioner_last", "pensioner_first", "cgr_records", curated, 3)
    return found.withColumnRenamed("id", "vet_id")


def curated_ranks(spark: SparkSession, d: str) -> DataFrame:
    """How often the candidate of each rank matched."""
    return crossref.match_ranks(curated_matches(spark, d))


def spouse_probe(spark: SparkSession, d: str) -> DataFrame:
    """The first of three registry copies with the record's names, and what became of each copy."""
    s = crossref.spouse_probe(_records(spark, d), "pensioner_id", "pensioner_first", "pensioner_last", "cgr_records", "first_name", "last_name", 3)
    return s.withColumn("outcomes", F.array_join("outcomes", "|"))


EVIDENCE = {"CGRCorroboration": "cgr_match", "DixieDataMatch": "dd_match", "SpouseMatch": "spouse_match"}


def observation_enrichment(spark: SparkSession, d: str) -> DataFrame:
    """Records with the last corroboration, curated match and spouse match of the log."""
    log = table(spark, d, "observations").select("pensioner_id", "kind", "payload", "recorded_at", "observation_id")
    last = crossref.latest_payloads(log, "pensioner_id", "kind", "payload", ["recorded_at", "observation_id"], EVIDENCE)
    return crossref.enriched(table(spark, d, "results").select("pensioner_id").distinct(), "pensioner_id", last)


def backlink_backfill(spark: SparkSession, d: str) -> DataFrame:
    """Records that have lost their link get it from the first row of their id."""
    r = table(spark, d, "results").select("pensioner_id", "backlink", "status", "processed_at")
    rows = r.select("pensioner_id", F.when(F.col("status") == "auto_accept", F.col("backlink")).otherwise("").alias("backlink")).distinct()
    return crossref.backfilled_links(rows, "pensioner_id", "backlink", r, ["processed_at"])


def page_annotations(spark: SparkSession, d: str) -> DataFrame:
    """The page numbers of each card, from the list of pages or from its image address."""
    r = table(spark, d, "results").groupBy("pensioner_id").agg(F.max("pensioncard_pages").alias("pages"), F.max("backlink").alias("backlink"))
    rows = r.select("pensioner_id", F.concat(F.regexp_replace(T.text("backlink"), "/pensions/", "/iiif/2/pensioncard:"), F.lit("/full")).alias("address"))
    found = crossref.with_pages(rows, "pensioner_id", "address", r.select("pensioner_id", "pages"))
    return found.select("pensioner_id", F.array_join(F.col("pages").cast("array<string>"), ",").alias("pages"), "pages_from")


def direct_links(spark: SparkSession, d: str) -> DataFrame:
    """Labels that name a cached memorial by its number."""
    labels, cache = table(spark, d, "label_snapshots"), table(spark, d, "memorial_cache")
    return crossref.direct_links(labels, "label_id", number_key(F.col("ground_truth_memorial_id")), cache, number_key(F.col("memorial_id")))


def name_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Evidence of the names of each record and its registry copies."""
    c = _copies(spark, d)
    score = crossref.name_evidence("pensioner_first", "pensioner_middle", "pensioner_last", "c.first_name", "c.middle_name", "c.last_name")
    return c.select("pensioner_id", "place", F.round(score, 2).alias("score"))


def widow_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Whether the spouse named in a registry row and a gravestone of that surname are one, by the gravestone's whole name."""
    v = table(spark, d, "registry_vets").where("trim(spouse) <> ''").select("id", F.upper(F.trim("last_name")).alias("k"), F.split("spouse", " ")[0].alias("first"), F.col("spouse").alias("whole")).distinct()
    g = table(spark, d, "open_gravestones").select("export_id", F.upper(F.trim("schema_familyname")).alias("k"), "schema_givenname", "dcterms_title").distinct()
    # a verdict needs a common first letter: the rows of a hot surname meet by it only
    head = lambda x: F.upper(F.substring(F.trim(x), 1, 1))
    pairs = v.withColumn("h", head("first")).join(g.withColumn("h", head("schema_givenname")), ["k", "h"]).where("k <> '' and h <> ''")
    verdict = crossref.widow_verdict("first", "k", "whole", "schema_givenname", "k", "dcterms_title", "dcterms_title", "k")
    return pairs.select("id", "export_id", verdict.alias("verdict")).where("verdict is not null").distinct()


def roster_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Registry rows against the roster of typed records, by surname, initial and the state of the unit."""
    roster = table(spark, d, "results").select(F.col("pensioner_last").alias("last"), F.col("pensioner_first").alias("first"), crossref.roster_state("regiment").alias("state"))
    local = table(spark, d, "registry_vets").select("id", "last_name", "first_name", "unit").distinct()
    return crossref.roster_join(local, "id", "last_name", "first_name", "unit", roster).groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


def common_units(spark: SparkSession, d: str) -> DataFrame:
    """The ten most frequent typed units."""
    return crossref.top_counts(table(spark, d, "results").where("trim(regiment) <> ''"), F.lower(F.trim("regiment")))


def _labels(spark: SparkSession, d: str) -> DataFrame:
    last = F.max(F.struct("extracted_at", "label_id", "human_review_decision", "ground_truth_memorial_id")).alias("x")
    return table(spark, d, "label_snapshots").where("pensioner_id is not null").groupBy("pensioner_id").agg(last).select("pensioner_id", F.col("x.human_review_decision").alias("decision"), F.col("x.ground_truth_memorial_id").alias("link"))


def decision_evaluation(spark: SparkSession, d: str) -> DataFrame:
    """How the status of each record agrees with its last label."""
    e = crossref.evaluation(_records(spark, d).select("pensioner_id", "status"), _labels(spark, d), "pensioner_id", "status", "decision")
    return e.select("total", "correct", *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall")])


def slug_shapes(spark: SparkSession, d: str) -> DataFrame:
    """Memorial slugs by the number of their words and whether the last has a hyphen."""
    m = table(spark, d, "memorial_cache").select("memorial_id", "slug").distinct().select(crossref.slug_shape("slug").alias("s"))
    return m.groupBy("s.parts", "s.hyphenated").agg(F.count(F.lit(1)).alias("n"))


def ladder_hits(spark: SparkSession, d: str) -> DataFrame:
    """Labelled records by the first strategy that would find their memorial, and how many any up to it finds."""
    slugs = table(spark, d, "memorial_cache").groupBy(number_key(F.col("memorial_id")).alias("link")).agg(F.min("slug").alias("slug"))
    labels = _labels(spark, d).select("pensioner_id", number_key(F.col("link")).alias("link")).where("link <> ''")
    pairs = labels.join(slugs, "link").join(_records(spark, d), "pensioner_id")
    return analytics.first_hit(pairs, crossref.ladder_hits("pensioner_first", "pensioner_middle", "pensioner_last", "pensioner_birth_year", "pensioner_death_year", "regiment", "slug"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            curated_matches, curated_ranks, spouse_probe, observation_enrichment, backlink_backfill, page_annotations, direct_links, name_evidence, widow_verdicts,
            roster_verdicts, common_units, decision_evaluation, slug_shapes, ladder_hits,
        )
    }


def _number(x: str) -> str:
    x = f"coalesce({x}, '')"
    return f"CASE WHEN lower({x}) LIKE '%memorial/%' THEN coalesce(nullif(regexp_extract(lower({x}), 'memorial/0*(\\d+)', 1), ''), lower(trim({x}))) WHEN regexp_extract({x}, '0*(\\d+)', 1) <> '' THEN regexp_extract({x}, '0*(\\d+)', 1) ELSE lower(trim({x})) END"


def _spouse(x: str) -> str:
    out = f"regexp_replace(lower(regexp_replace(trim(coalesce({x}, '')), '\\.+$', '')), '\\s+', ' ', 'g')"
    for s in ("sr", "jr", "ii", "iii", "iv"):
        out = f"regexp_replace({out}, ' {s}$', '')"
    return out


def oracle_sql() -> dict[str, str]:
    rec = _records_sql()
    key = lambda x: f"upper(regexp_replace(trim(coalesce({x}, '')), '\\.+$', ''))"
    text = lambda x: f"coalesce({x}, '')"
    letters = lambda x: f"regexp_replace(lower({text(x)}), '[^a-z]', '', 'g')"
    words = lambda x: f"trim(regexp_replace(regexp_replace(lower(trim({text(x)})), '[^a-z\\s]', '', 'g'), '\\s+', ' ', 'g'))"
    tried = f"t AS (SELECT pensioner_id, {key('pensioner_last')} AS l, substr({key('pensioner_first')}, 1, 1) AS f, unnest(cgr_records[1:3]) AS c, generate_subscripts(cgr_records[1:3], 1) AS rank FROM rec), k AS (SELECT DISTINCT {key('last_name')} AS l, substr({key('first_name')}, 1, 1) AS f, id FROM registry_vets), hit AS (SELECT t.pensioner_id, CAST(min(rank) AS INTEGER) AS rank, arg_min(t.c.id, rank) AS vet_id FROM t JOIN k ON t.l = k.l AND t.f = k.f AND t.c.id = k.id WHERE t.l <> '' AND t.f <> '' GROUP BY 1)"
    strength = f"CASE WHEN a <> '' AND b <> '' AND x <> '' AND y <> '' THEN CASE WHEN a = x AND b = y THEN 'strong' WHEN b = y THEN 'medium' END END"
    forms = "(VALUES " + ", ".join(f"('{k}', {[k, *v]})" for k, v in T.SHORT_FORMS.items()) + ") "
    last = lambda k: f"(SELECT pensioner_id, payload FROM (SELECT *, row_number() OVER (PARTITION BY pensioner_id ORDER BY recorded_at DESC NULLS LAST, observation_id DESC, payload DESC NULLS LAST) AS n FROM observations WHERE kind = '{k}' AND pensioner_id <> 0) WHERE n = 1)"
    labels = "lab AS (SELECT pensioner_id, human_review_decision AS t, ground_truth_memorial_id AS link FROM (SELECT *, row_number() OVER (PARTITION BY pensioner_id ORDER BY extracted_at DESC NULLS LAST, label_id DESC, human_review_decision DESC, ground_truth_memorial_id DESC NULLS LAST) AS n FROM label_snapshots WHERE pensioner_id IS NOT NULL) WHERE n = 1)"
    state = lambda x: f"regexp_extract({text(x)}, '(?i)\\b([A-Z]{{2}})\\b\\s+(?:{crossref.ROSTER_UNITS})\\b', 1)"
    up = lambda x: f"upper(trim({text(x)}))"
    head = lambda a, b: f"({a} <> '' AND {b} <> '' AND substr({a}, 1, 1) = substr({b}, 1, 1))"
    died = "CASE WHEN regexp_matches(trim(coalesce(pensioner_death_year, '')), '^\\d+$') THEN try_cast(trim(pensioner_death_year) AS INTEGER) END"
    hits = {
        "exact": f"f <> '' AND sf = f AND (m = '' OR sm = m OR {head('sm', 'm')}) AND sl = l",
        "first initial, exact": f"length(f) = 1 AND {head('f', 'sf')}",
        "middle initial": head("m", "sm"),
        "first initial, surname": f"l <> '' AND sl = l AND {head('f', 'sf')}",
        "surname": "l <> '' AND sl = l",
        "war context": "unit <> '' OR coalesce(born > 1700 AND born < 2100, FALSE)",
        "home": "coalesce(died BETWEEN 1910 AND 1940, FALSE)",
        "unit state": "regexp_matches(unit, '\\b[A-Z]{2}\\b')",
        "abbreviation": f"f IN ({', '.join(repr(x) for x in crossref.ABBREVIATED)})",
        "apostrophe": "contains(whole, '''') OR contains(slug, '''')",
    }
    tier = "CASE " + " ".join(f"WHEN {c} THEN {i}" for i, c in enumerate(hits.values())) + " END"
    return {
        "curated_matches": f"WITH {rec}, {tried} SELECT * FROM hit",
        "curated_ranks": f"WITH {rec}, {tried} SELECT rank, count(*) AS n FROM hit GROUP BY rank",
        "spouse_probe": f"""WITH {rec}, t AS (SELECT pensioner_id, {_spouse('pensioner_first')} AS a, {_spouse('pensioner_last')} AS b, unnest(cgr_records[1:3]) AS c, generate_subscripts(cgr_records[1:3], 1) AS i FROM rec WHERE len(cgr_records) > 0),
            p AS (SELECT *, {_spouse('c.first_name')} AS x, {_spouse('c.last_name')} AS y FROM t), s AS (SELECT pensioner_id, i, {strength} AS s FROM p), h AS (SELECT pensioner_id, min(i) FILTER (WHERE s IS NOT NULL) AS hit FROM s GROUP BY 1)
            SELECT s.pensioner_id, CAST(coalesce(any_value(hit), 0) AS INTEGER) AS rank, max(s) FILTER (WHERE i = hit) AS strength, string_agg(CASE WHEN hit IS NULL OR i < hit THEN 'no' WHEN i = hit THEN s ELSE 'skipped' END, '|' ORDER BY i) AS outcomes FROM s JOIN h ON h.pensioner_id = s.pensioner_id GROUP BY s.pensioner_id""",
        "observation_enrichment": "SELECT r.pensioner_id, " + ", ".join(f"{v}.payload AS {v}" for v in EVIDENCE.values()) + ", " + " OR ".join(f"{v}.payload IS NOT NULL" for v in EVIDENCE.values()) + " AS enriched FROM (SELECT DISTINCT pensioner_id FROM results) r " + " ".join(f"LEFT JOIN {last(k)} {v} ON {v}.pensioner_id = r.pensioner_id" for k, v in EVIDENCE.items()),
        "backlink_backfill": "WITH r AS (SELECT DISTINCT pensioner_id, CASE WHEN status = 'auto_accept' THEN backlink ELSE '' END AS backlink FROM results), s AS (SELECT * FROM (SELECT pensioner_id, coalesce(backlink, '') AS b, row_number() OVER (PARTITION BY pensioner_id ORDER BY processed_at NULLS FIRST, coalesce(backlink, '')) AS n FROM results) WHERE n = 1) SELECT r.pensioner_id, CASE WHEN coalesce(backlink, '') <> '' THEN backlink ELSE coalesce(b, '') END AS backlink, CASE WHEN coalesce(backlink, '') <> '' THEN 'skipped' WHEN coalesce(b, '') <> '' THEN 'filled' ELSE 'missing' END AS outcome FROM r LEFT JOIN s ON s.pensioner_id = r.pensioner_id",
        "page_annotations": "WITH r AS (SELECT pensioner_id, max(pensioncard_pages) AS pages, max(backlink) AS b FROM results GROUP BY 1), p AS (SELECT *, coalesce(len(pages) > 0, FALSE) AS has, regexp_extract(replace(coalesce(b, ''), '/pensions/', '/iiif/2/pensioncard:') || '/full', '/pensioncard:(\\d+)/', 1) AS id FROM r) SELECT pensioner_id, CASE WHEN has THEN array_to_string(pages, ',') WHEN id <> '' THEN CAST(CAST(id AS BIGINT) AS VARCHAR) END AS pages, CASE WHEN has THEN 'sidecar' WHEN id <> '' THEN 'derived' ELSE 'none' END AS pages_from FROM p",
        "direct_links": f"SELECT DISTINCT l.label_id, l.k AS candidate_id, CAST(1 AS DOUBLE) AS confidence FROM (SELECT label_id, {_number('ground_truth_memorial_id')} AS k FROM label_snapshots) l JOIN (SELECT DISTINCT {_number('memorial_id')} AS k FROM memorial_cache) m ON m.k = l.k WHERE l.k <> ''",
        "name_evidence": f"""WITH {rec}, c AS (SELECT pensioner_id, pensioner_first, pensioner_middle, pensioner_last, unnest(cgr_records) AS c, generate_subscripts(cgr_records, 1) - 1 AS place FROM rec), w AS (SELECT pensioner_id, CAST(place AS INTEGER) AS place, {words('pensioner_last')} AS la, {words('c.last_name')} AS lb, {words('pensioner_first')} AS fa, {words('c.first_name')} AS fb, {up('pensioner_middle')} AS ma, {up('c.middle_name')} AS mb FROM c WHERE c.id IS NOT NULL)
            SELECT pensioner_id, place, round(least(CASE WHEN la = lb THEN 0.5 WHEN la <> '' AND lb <> '' AND (contains(la, lb) OR contains(lb, la)) THEN 0.25 ELSE 0 END + CASE WHEN fa = fb THEN 0.35 WHEN fa <> '' AND fb <> '' AND list_has_any(coalesce(x.v, [fa]), coalesce(y.v, [fb])) THEN 0.3 ELSE 0 END + CASE WHEN ma <> '' AND mb <> '' AND substr(ma, 1, 1) = substr(mb, 1, 1) THEN 0.05 ELSE 0 END, 1)::DOUBLE, 2) AS score
            FROM w LEFT JOIN {forms} x(k, v) ON x.k = fa LEFT JOIN {forms} y(k, v) ON y.k = fb""",
        "widow_verdicts": f"""WITH v AS (SELECT DISTINCT id, {up('last_name')} AS k, split_part(spouse, ' ', 1) AS a, spouse AS wa FROM registry_vets WHERE trim(spouse) <> ''), g AS (SELECT DISTINCT export_id, {up('schema_familyname')} AS k, schema_givenname AS b, dcterms_title AS wb FROM open_gravestones), p AS (SELECT *, {up('a')} AS x, {up('b')} AS y FROM v JOIN g USING (k) WHERE k <> '' AND upper(substr(trim(a), 1, 1)) = upper(substr(trim(b), 1, 1)) AND substr(trim(a), 1, 1) <> ''),
            s AS (SELECT *, CASE WHEN x = '' OR y = '' THEN NULL WHEN x = y OR list_contains(list_transform(regexp_extract_all({text('wa')}, '"([^"]+)"', 1), lambda q: upper(q)), y) OR list_contains(list_transform(regexp_extract_all({text('wb')}, '"([^"]+)"', 1), lambda q: upper(q)), x) THEN 'strong' WHEN (length(x) >= 3 AND length(y) >= 3 AND x[1:3] = y[1:3]) OR (x[1:1] = y[1:1] AND (length(x) = 1 OR length(y) = 1)) THEN 'loose' END AS f, contains({up('wb')}, k) AS named FROM p)
            SELECT DISTINCT id, export_id, CASE WHEN {up('wb')} = '' THEN 'loose' WHEN named AND f = 'strong' THEN 'strong' WHEN named THEN 'loose' END AS verdict FROM s WHERE f IS NOT NULL AND (named OR {up('wb')} = '')""",
        "roster_verdicts": f"""WITH i AS (SELECT {letters('pensioner_last')} AS l, substr({letters('pensioner_first')}, 1, 1) AS f, list(DISTINCT {state('regiment')}) AS s FROM results GROUP BY 1, 2), r AS (SELECT DISTINCT id, last_name, first_name, unit FROM registry_vets), q AS (SELECT id, {letters('last_name')} AS l, substr({letters('first_name')}, 1, 1) AS f, {state('unit')} AS u FROM r)
            SELECT CASE WHEN q.l = '' OR q.f = '' THEN 'no name' WHEN s IS NULL THEN 'no roster entry' WHEN u = '' OR list_contains(s, u) THEN 'matched' ELSE 'other state' END AS verdict, count(*) AS n FROM q LEFT JOIN i ON i.l = q.l AND i.f = q.f AND i.l <> '' AND i.f <> '' GROUP BY 1""",
        "common_units": "SELECT lower(trim(regiment)) AS value, count(*) AS n FROM results WHERE trim(regiment) <> '' GROUP BY 1 ORDER BY n DESC, value LIMIT 10",
        "decision_evaluation": f"""WITH {rec}, {labels}, j AS (SELECT coalesce(status = 'auto_accept', FALSE) AS auto, t FROM rec LEFT JOIN lab ON lab.pensioner_id = rec.pensioner_id), s AS (SELECT count(*) AS total, count(*) FILTER (WHERE t IS NULL OR (t = 'accepted' AND auto) OR (t = 'rejected' AND NOT auto)) AS correct, count(*) FILTER (WHERE t = 'accepted' AND auto) AS tp, count(*) FILTER (WHERE t = 'rejected' AND auto) AS fp, count(*) FILTER (WHERE t = 'accepted' AND NOT auto) AS fn FROM j)
            SELECT total, correct, round(CASE WHEN total = 0 THEN 0 ELSE correct / total END, 6) AS accuracy, round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision, round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall FROM s""",
        "slug_shapes": "WITH m AS (SELECT DISTINCT memorial_id, slug FROM memorial_cache), p AS (SELECT string_split(split_part(coalesce(slug, ''), '/', 1), '_') AS b FROM m) SELECT CAST(len(b) AS INTEGER) AS parts, contains(list_extract(b, -1), '-') AS hyphenated, count(*) AS n FROM p GROUP BY ALL",
        "ladder_hits": f"""WITH {rec}, {labels}, sl AS (SELECT {_number('memorial_id')} AS link, min(slug) AS slug FROM memorial_cache GROUP BY 1), parts AS (SELECT memorial_id AS slug, first, middle, last FROM ({names_sql()['slug_names'].replace('memorial_cache', '(SELECT slug AS memorial_id, slug FROM memorial_cache)')})),
            j AS (SELECT r.*, s.slug, {letters('pensioner_first')} AS f, {letters('pensioner_middle')} AS m, {letters('pensioner_last')} AS l, {letters('p.first')} AS sf, {letters('p.middle')} AS sm, {letters('p.last')} AS sl, {text('regiment')} AS unit, {text('pensioner_last')} AS whole, try_cast(regexp_extract({text('pensioner_birth_year')}, '(\\d{{4}})', 1) AS INTEGER) AS born, {died} AS died FROM lab JOIN sl s ON s.link = {_number('lab.link')} AND s.link <> '' JOIN rec r ON r.pensioner_id = lab.pensioner_id JOIN parts p ON p.slug = s.slug),
            h AS (SELECT {tier} AS i, count(*) AS n FROM j GROUP BY 1), t AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{k}')" for i, k in enumerate(hits))}) v(i, tier))
            SELECT tier, coalesce(n, 0) AS n, CAST(sum(coalesce(n, 0)) OVER (ORDER BY t.i) AS BIGINT) AS cumulative FROM t LEFT JOIN h ON h.i = t.i""",
    }
