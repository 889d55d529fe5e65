"""Blocking, verdicts, corroboration, duplicates, scoring and decisions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollweave.functions import text as T
from rollweave.functions.phonetic import combined_score, name_similarity
from rollweave.operators import blocking, linkage, merge, scoring
from rollweave.operators.analytics import status_histogram
from rollweave.queries.names import _letters, fold_sql, soundex_sql
from rollweave.session import table


def _records(spark: SparkSession, d: str) -> DataFrame:
    """The first row of each pensioner."""
    r = table(spark, d, "results").drop("pensioncard_pages")
    keep = [c for c in r.columns if c not in ("pensioner_id", "processed_at")]
    return r.groupBy("pensioner_id").agg(F.min(F.struct("processed_at", *keep)).alias("r")).select("pensioner_id", "r.*")


def _copies(spark: SparkSession, d: str) -> DataFrame:
    """Registry copies of each pensioner with their place."""
    r = _records(spark, d).select("pensioner_id", "pensioner_first", "pensioner_middle", "pensioner_last", "pensioner_birth_year", "pensioner_death_year", "regiment", "fag_status", F.posexplode("cgr_records").alias("place", "c"))
    return r.where("c.id is not null")


def scored_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Every registry copy scored as a candidate of its record."""
    c = _copies(spark, d).withColumn("state", T.unit_state("regiment"))
    slug = F.lower(F.regexp_replace(F.trim(T.text("c.name")), r"\s+", "-"))
    local = {"first": "pensioner_first", "middle": "pensioner_middle", "last": "pensioner_last", "state": "state", "death": "pensioner_death_year"}
    found = {"slug": slug, "state": "c.state", "veteran": F.lit(True), "birth": "c.born", "death": T.year_anywhere("c.died").cast("string")}
    f = scoring.with_features(c, "f", local, found)
    return f.select("pensioner_id", "place", F.col("c.id").alias("vet_id"), F.col("pensioner_death_year").alias("death_year"), scoring.weighted_score("f").alias("score"), F.col("f.last").alias("f_last"), F.col("f.first").alias("f_first"), F.col("f.death").alias("f_death"))


def candidate_scores(spark: SparkSession, d: str) -> DataFrame:
    return scored_candidates(spark, d).withColumn("score", F.round("score", 6))


def decide_records(spark: SparkSession, d: str) -> DataFrame:
    """One decision per record with candidates: score, rank, gap, threshold."""
    decided = scoring.decide(scored_candidates(spark, d).withColumn("score", F.round("score", 9)), "pensioner_id", "score", "death_year")
    return decided.select("pensioner_id", "candidates", F.round("top_score", 6).alias("top_score"), F.round("second_score", 6).alias("second_score"), "status", F.round("gap", 6).alias("gap"), "threshold")


def top_candidates(spark: SparkSession, d: str) -> DataFrame:
    """The twenty best candidates of each record, ties in their original order."""
    s = scored_candidates(spark, d).withColumn("score", F.round("score", 6))
    return merge.top_per_key(s, "pensioner_id", "score", ["place"]).select("pensioner_id", "vet_id", "place", "rank")


def merged_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Candidates that several records share, merged by best score, earliest first."""
    s = scored_candidates(spark, d).withColumn("score", F.round("score", 6))
    return merge.merge_best(s, ["vet_id"], "score", ["pensioner_id", "place"], ["pensioner_id"]).select("vet_id", "score", "pensioner_id")


def merged_strategies(spark: SparkSession, d: str) -> DataFrame:
    """Registry copies merged by id, first one wins, with all their sources in order of appearance."""
    c = _copies(spark, d).select("pensioner_id", "place", F.col("c.id").alias("vet_id"), T.text("c.source").alias("source"), T.text("c.name").alias("name"))
    return merge.merge_first(c, ["vet_id"], ["pensioner_id", "place"], "source", ["name"]).select("vet_id", "name", F.array_join("via_strategies", "|").alias("via"))


def date_window(spark: SparkSession, d: str) -> DataFrame:
    """Registry rows whose years are plausible."""
    v = table(spark, d, "registry_vets").select("id", "born", "died").distinct()
    return v.where(scoring.in_window("born", "died"))


def outliers(spark: SparkSession, d: str) -> DataFrame:
    """Records that failed or scored below the floor, with their score bucket and derived status."""
    r = _records(spark, d)
    return r.where(scoring.is_outlier("status", "best_score")).select("pensioner_id", "status", scoring.score_bucket("best_score").alias("bucket"), scoring.status_of_score(F.coalesce("best_score", F.lit(0.0)), "fag_status").alias("derived"))


def registry_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Name strength and verdict of each registry copy; phonetic agreement from codes computed once per name."""
    c = _copies(spark, d)
    n = c.select("pensioner_id", "place", F.col("c.id").alias("vet_id"), T.trim_lower("pensioner_first").alias("pf"), T.trim_lower("pensioner_last").alias("pl"), T.split_name(T.text("c.name")).alias("n"), "regiment", F.col("c.unit").alias("unit"), "pensioner_birth_year", F.col("c.born").alias("born"))
    n = n.select("*", T.trim_lower("n.first").alias("cf"), T.trim_lower("n.last").alias("cl"))
    coded = blocking.with_codes(n, {"pf": "pf", "pl": "pl", "cf": "cf", "cl": "cl"})
    score = lambda a, b: combined_score(a, b, F.col(f"jw_{a}"), F.col(f"{a}_metaphone") == F.col(f"{b}_metaphone"), F.col(f"{a}_nysiis") == F.col(f"{b}_nysiis"))
    coded = coded.withColumns({"jw_pl": name_similarity("pl", "cl"), "jw_pf": name_similarity("pf", "cf")})
    strength = linkage.strength_bucket(score("pl", "cl"), score("pf", "cf"), (F.col("pl") != "") & (F.col("cl") != ""), (F.col("pf") != "") & (F.col("cf") != ""))
    out = coded.withColumn("strength", strength)
    return out.select("pensioner_id", "place", "vet_id", "strength", linkage.registry_verdict(F.col("strength"), "regiment", "unit", "pensioner_birth_year", "born").alias("verdict"))


def year_and_unit_agreement(spark: SparkSession, d: str) -> DataFrame:
    """How years and units of records and their registry copies agree."""
    c = _copies(spark, d)
    return c.select("pensioner_id", "place", linkage.year_bucket("pensioner_birth_year", "c.born").alias("years"), linkage.units_agree("regiment", "c.unit").alias("units"))


def duplicate_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """The best registry match of each record and what it means beside the search."""
    c = _copies(spark, d)
    s = c.select("pensioner_id", "fag_status", linkage.duplicate_strength("pensioner_last", "pensioner_first", "regiment", "pensioner_birth_year", "c.last_name", "c.first_name", "c.unit", "c.born").alias("strength"))
    best = s.groupBy("pensioner_id").agg(F.max(linkage.strength_rank("strength")).alias("r"), F.max("fag_status").alias("fag_status"), F.count(F.lit(1)).alias("candidates"))
    name = F.element_at(F.array(F.lit("none"), F.lit("weak"), F.lit("medium"), F.lit("strong")), F.col("r") + 1)
    return best.withColumn("strength", name).select("pensioner_id", "candidates", "strength", linkage.duplicate_status(F.col("strength"), "fag_status", F.lit(False)).alias("dedup_status"))


def corroborated(spark: SparkSession, d: str) -> DataFrame:
    """The first copy of each record that another copy of it corroborates."""
    c = _copies(spark, d).select("pensioner_id", "place", F.col("c.id").alias("vet_id"), F.col("c.first_name").alias("f"), F.col("c.last_name").alias("l"), F.col("c.died").alias("died"), F.col("c.state").alias("state"))
    a, b = c.alias("a"), c.alias("b")
    pairs = a.join(b, (F.col("a.pensioner_id") == F.col("b.pensioner_id")) & (F.col("a.place") < F.col("b.place")))
    conf = linkage.corroboration(linkage.soft_name_match("a.f", "a.l", "b.f", "b.l"), "a.died", "b.died", "a.state", "b.state")
    flat = pairs.select(F.col("a.pensioner_id").alias("pensioner_id"), F.col("a.place").alias("place_a"), F.col("b.place").alias("place_b"), F.col("a.vet_id").alias("vet_a"), F.col("b.vet_id").alias("vet_b"), conf.alias("confidence"))
    return linkage.first_corroborated(flat, "pensioner_id", "place_a", "place_b", "confidence")


def _registry(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "registry_vets")
    keep = [c for c in v.columns if c not in ("id", "vet_fetched_at")]
    return v.groupBy("id").agg(F.min(F.struct("vet_fetched_at", *keep)).alias("r")).select("id", "r.*")


def duplicate_edges(spark: SparkSession, d: str) -> DataFrame:
    """Registry rows that stand for the same person."""
    return linkage.same_person_edges(_registry(spark, d), "id", "first_name", "last_name", "born", "died", "cemetery_id", "unit", "mil_rank")


def canonical_persons(spark: SparkSession, d: str) -> DataFrame:
    """Each registry row with its canonical person."""
    return linkage.canonical_persons(_registry(spark, d), "id", duplicate_edges(spark, d))


def person_fields(spark: SparkSession, d: str) -> DataFrame:
    """Merged fields of each canonical person."""
    members = _registry(spark, d).join(canonical_persons(spark, d).select("id", "person_id"), "id")
    m = linkage.merged_fields(members, "person_id", "id", {"first_name": "first_name", "last_name": "last_name", "spouse": "spouse", "regiment": "unit"}, {"birth_year": "born", "death_year": "died"}, "cemetery_id")
    return m.withColumn("place_ids", F.array_join(F.transform("place_ids", lambda x: x.cast("string")), ","))


def block_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Registry rows per block of the surname-prefix family."""
    index = blocking.block_index(_registry(spark, d), "id", "name")
    return index.groupBy(F.element_at(F.split("block_key", ":"), 1).alias("family"), F.col("block_key")).agg(F.count(F.lit(1)).alias("n")).where("family = 'surname_prefix'").select("block_key", "n")


def block_families(spark: SparkSession, d: str) -> DataFrame:
    """Registry rows per block of every family, those of sound included."""
    index = blocking.block_index(_registry(spark, d), "id", "name")
    return index.groupBy(F.element_at(F.split("block_key", ":"), 1).alias("family"), "block_key").agg(F.count(F.lit(1)).alias("n"))


def block_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Up to twenty registry rows per gravestone export by shared blocks."""
    index = blocking.block_index(_registry(spark, d), "id", "name")
    return blocking.block_lookup(table(spark, d, "open_gravestones"), "export_id", "schema_givenname", "schema_familyname", index, "id", 20)


def tiered_fill(spark: SparkSession, d: str) -> DataFrame:
    """Exports with the application number of a record, by title, then by surname and death year, then by surname."""
    r = _records(spark, d).select("pensioner_id", F.lower(F.trim("pensioner_name")).alias("k1"), F.concat_ws("|", F.nullif(F.lower(F.trim("pensioner_last")), F.lit("")), F.nullif(F.trim("pensioner_death_year"), F.lit(""))).alias("k2"), F.lower(F.trim("pensioner_last")).alias("k3"), "pensioner_app_number")
    r = r.withColumn("k2", F.when(F.col("k2").contains("|"), F.col("k2")))
    o = table(spark, d, "open_gravestones").select("export_id", F.lower(F.trim("dcterms_title")).alias("t1"), F.concat_ws("|", F.nullif(F.lower(F.trim("schema_familyname")), F.lit("")), F.nullif(F.trim("schema_deathdate"), F.lit(""))).alias("t2"), F.lower(F.trim("schema_familyname")).alias("t3"))
    o = o.withColumn("t2", F.when(F.col("t2").contains("|"), F.col("t2")))
    return linkage.tiered_join(o, r, [("t1", "k1"), ("t2", "k2"), ("t3", "k3")], {"app_number": "pensioner_app_number"}, "pensioner_id").select("export_id", "app_number", F.coalesce("tier", F.lit(-1)).alias("tier"))


def status_counts(spark: SparkSession, d: str) -> DataFrame:
    """Records in total and per listed status."""
    return status_histogram(_records(spark, d), "status", ["auto_accept", "needs_review", "low_score", "no_candidates", "error"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            candidate_scores, decide_records, top_candidates, merged_candidates, merged_strategies, date_window, outliers, registry_verdicts, year_and_unit_agreement, duplicate_verdicts, corroborated, duplicate_edges, canonical_persons, person_fields,
            block_sizes, block_families, block_candidates, tiered_fill, status_counts,
        )
    }


def _records_sql() -> str:
    return "rec AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pensioner_id ORDER BY processed_at NULLS FIRST, pensioner_app_number) AS rn FROM results) WHERE rn = 1)"


def _copies_sql() -> str:
    return _records_sql() + ", flat AS (SELECT r.*, unnest(range(len(cgr_records))) AS place FROM rec r), cop AS (SELECT flat.*, cgr_records[place + 1] AS c FROM flat WHERE cgr_records[place + 1].id IS NOT NULL)"


def _score_sql() -> str:
    up = "upper(regexp_replace(coalesce(regiment, ''), '\\bCo\\.', 'Co', 'g'))"
    named = "CASE " + " ".join(f"WHEN contains({up}, '{k}') THEN '{v}'" for k, v in T.STATE_NAMES.items()) + " ELSE '' END"
    state = f"coalesce(list_extract(list_filter(regexp_extract_all({up}, '\\b({'|'.join(T.STATE_CODES)})\\b'), lambda x: x <> 'CO'), 1), {named})"
    return f"""{_copies_sql()},
s0 AS (SELECT pensioner_id, place, c.id AS vet_id, pensioner_death_year AS death_year, pensioner_first, pensioner_middle, pensioner_last, {state} AS st, upper(coalesce(c.state, '')) AS cs, split_part(lower(regexp_replace(trim(coalesce(c.name, '')), '\\s+', '-', 'g')), '/', 1) AS slug,
  try_cast(regexp_extract(coalesce(c.born, ''), '(\\d{{4}})', 1) AS INTEGER) AS b, try_cast(regexp_extract(coalesce(c.died, ''), '(\\d{{4}})', 1) AS INTEGER) AS dd, try_cast(trim(coalesce(pensioner_death_year, '')) AS INTEGER) AS ld FROM cop),
s1 AS (SELECT *, string_split(slug, '-') AS h FROM s0),
s2 AS (SELECT *, h[1] AS sf, CASE WHEN len(h) > 2 THEN array_to_string(h[2:len(h)-1], ' ') ELSE '' END AS sm, CASE WHEN len(h) > 1 THEN h[len(h)] ELSE '' END AS sl FROM s1),
s3 AS (SELECT *, {_letters('pensioner_first')} AS lf_, {_letters('pensioner_middle')} AS lm_, {_letters('pensioner_last')} AS ll_, {_letters('sf')} AS sf_, {_letters('sm')} AS sm_, {_letters('sl')} AS sl_, {soundex_sql('pensioner_last')} AS xl, {soundex_sql('sl')} AS xsl, {soundex_sql('pensioner_first')} AS xf, {soundex_sql('sf')} AS xsf FROM s2),
s4 AS (SELECT *, (b IS NULL OR b BETWEEN 1810 AND 1880) AND (dd IS NULL OR dd BETWEEN 1861 AND 1955) AS ok FROM s3),
s5 AS (SELECT *, CASE WHEN NOT ok THEN 0 WHEN ll_ = sl_ THEN 1.0 WHEN ll_ <> '' AND sl_ <> '' AND (starts_with(ll_, sl_) OR starts_with(sl_, ll_)) THEN 0.7 WHEN sl_ <> '' AND xl = xsl THEN 0.5 ELSE 0 END AS f_last,
  CASE WHEN NOT ok THEN 0 WHEN lf_ = sf_ THEN 1.0 WHEN lf_ <> '' AND sf_ <> '' AND substr(lf_,1,1) = substr(sf_,1,1) THEN 0.6 WHEN sf_ <> '' AND xf = xsf THEN 0.4 ELSE 0 END AS f_first,
  CASE WHEN NOT ok THEN 0 WHEN lm_ = '' THEN 0.5 WHEN sm_ = '' THEN 0 WHEN lm_ = sm_ THEN 1.0 WHEN substr(lm_,1,1) = substr(sm_,1,1) THEN 0.5 ELSE 0 END AS f_middle,
  CASE WHEN ok AND cs = 'OK' THEN 0.3 ELSE 0 END AS f_home, CASE WHEN ok AND st <> '' AND upper(st) = cs THEN 0.1 ELSE 0 END AS f_state, CASE WHEN ok THEN 0.8 ELSE 0 END AS f_vet,
  CASE WHEN NOT ok THEN 0 WHEN abs(ld - dd) = 0 THEN 0.5 WHEN abs(ld - dd) <= 2 THEN 0.4 WHEN abs(ld - dd) <= 5 THEN 0.2 ELSE 0 END AS f_death FROM s4),
sc AS (SELECT pensioner_id, place, vet_id, death_year, CAST(0.22 AS DOUBLE) * f_last + CAST(0.17 AS DOUBLE) * f_first + CAST(0.11 AS DOUBLE) * f_middle + CAST(0.10 AS DOUBLE) * f_home + CAST(0.05 AS DOUBLE) * f_state + CAST(0.18 AS DOUBLE) * f_vet + CAST(0.22 AS DOUBLE) * f_death AS score, CAST(f_last AS DOUBLE) AS f_last, CAST(f_first AS DOUBLE) AS f_first, CAST(f_death AS DOUBLE) AS f_death FROM s5)"""


def oracle_sql() -> dict[str, str]:
    scored = "WITH " + _score_sql()
    r6 = "sr AS (SELECT *, round(score, 6) AS s FROM sc)"
    states = "[" + ", ".join(f"CASE WHEN regexp_matches(upper(coalesce(%s, '')), '\\b{s}\\b') THEN '{s}' END" for s in linkage.UNIT_STATES) + "]"
    st = lambda x: f"list_filter({states.replace('%s', x)}, lambda x: x IS NOT NULL)"
    year = lambda x: f"try_cast(regexp_extract(coalesce({x}, ''), '(\\d{{4}})', 1) AS INTEGER)"
    gap = f"abs({year('pensioner_birth_year')} - {year('c.born')})"
    unit = lambda x: f"trim(regexp_replace(regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9\\s-]', ' ', 'g'), '\\s+', ' ', 'g'))"
    low = lambda x: f"lower(trim(coalesce({x}, '')))"
    lead = lambda x: f"try_cast(regexp_extract(coalesce({x}, ''), '^\\s*(\\d{{4}})', 1) AS INTEGER)"
    pre = " ".join(f"WHEN length(a.f) >= {k} AND length(b.f) >= {k} AND substr(a.f,1,{k}) = substr(b.f,1,{k}) THEN {k}" for k in (4, 3, 2, 1))
    edges = f"""reg AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY vet_fetched_at NULLS FIRST, name NULLS FIRST) AS rn FROM registry_vets) WHERE rn = 1),
n AS (SELECT id, {fold_sql('first_name')} AS f, {fold_sql('last_name')} AS l, {lead('born')} AS born, {lead('died')} AS died, cemetery_id AS place, {fold_sql('unit')} AS unit, {fold_sql('mil_rank')} AS rank FROM reg WHERE id IS NOT NULL),
e AS (SELECT a.id AS a, b.id AS b FROM n a JOIN n b ON a.l = b.l AND a.id < b.id WHERE a.l <> '' AND a.f <> '' AND b.f <> ''
  AND (abs(a.born - b.born) <= 2 OR abs(a.died - b.died) <= 2 OR a.place = b.place OR (a.unit <> '' AND a.unit = b.unit) OR (a.rank <> '' AND a.rank = b.rank))
  AND (a.f = b.f OR jaro_similarity(a.f, b.f) + 0.1 * (CASE {pre} ELSE 0 END) * (1 - jaro_similarity(a.f, b.f)) >= 0.90))"""
    persons = f"""WITH RECURSIVE {edges}, both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e), reach(id, seen) AS (SELECT DISTINCT a, a FROM both_ways UNION SELECT r.id, w.b FROM reach r JOIN both_ways w ON r.seen = w.a),
root AS (SELECT id, min(seen) AS root FROM reach GROUP BY id), al AS (SELECT reg.id, coalesce(root.root, reg.id) AS root FROM reg LEFT JOIN root ON root.id = reg.id WHERE reg.id IS NOT NULL),
pers AS (SELECT id, 'person_' || root AS person_id, count(*) OVER (PARTITION BY root) AS size FROM al)"""
    filled = lambda c: f"coalesce(arg_min(trim({c}), m.id) FILTER (WHERE trim(coalesce({c}, '')) <> ''), '')"
    soft = f"""({_letters('a.l')} <> '' AND {_letters('b.l')} <> '' AND ({_letters('a.l')} = {_letters('b.l')} OR (length({_letters('a.l')}) > 2 AND length({_letters('b.l')}) > 2 AND (starts_with({_letters('a.l')}, substr({_letters('b.l')},1,3)) OR starts_with({_letters('b.l')}, substr({_letters('a.l')},1,3)))))
      AND ({_letters('a.f')} = {_letters('b.f')} OR ({_letters('a.f')} <> '' AND {_letters('b.f')} <> '' AND substr({_letters('a.f')},1,1) = substr({_letters('b.f')},1,1))))"""
    meet = "len(list_filter(regexp_extract_all(coalesce(a.died,''), '\\b(\\d{4})\\b'), lambda x: len(list_filter(regexp_extract_all(coalesce(b.died,''), '\\b(\\d{4})\\b'), lambda y: abs(CAST(x AS INTEGER) - CAST(y AS INTEGER)) <= 2)) > 0)) > 0"
    return {
        "tiered_fill": f"""WITH {_records_sql()}, r AS (SELECT pensioner_id, pensioner_app_number AS app, lower(trim(pensioner_name)) AS k1, CASE WHEN coalesce(trim(pensioner_last), '') <> '' AND coalesce(trim(pensioner_death_year), '') <> '' THEN lower(trim(pensioner_last)) || '|' || trim(pensioner_death_year) END AS k2, lower(trim(pensioner_last)) AS k3 FROM rec),
            o AS (SELECT export_id, lower(trim(dcterms_title)) AS t1, CASE WHEN coalesce(trim(schema_familyname), '') <> '' AND coalesce(trim(schema_deathdate), '') <> '' THEN lower(trim(schema_familyname)) || '|' || trim(schema_deathdate) END AS t2, lower(trim(schema_familyname)) AS t3 FROM open_gravestones),
            {", ".join(f"s{i} AS (SELECT k, app FROM (SELECT k{i} AS k, app, row_number() OVER (PARTITION BY k{i} ORDER BY pensioner_id DESC) AS n FROM r WHERE coalesce(k{i}, '') <> '') WHERE n = 1)" for i in (1, 2, 3))}
            SELECT export_id, coalesce(CASE WHEN s1.k IS NOT NULL THEN s1.app WHEN s2.k IS NOT NULL THEN s2.app WHEN s3.k IS NOT NULL THEN s3.app END, '') AS app_number, CASE WHEN s1.k IS NOT NULL THEN 0 WHEN s2.k IS NOT NULL THEN 1 WHEN s3.k IS NOT NULL THEN 2 ELSE -1 END AS tier FROM o LEFT JOIN s1 ON s1.k = t1 LEFT JOIN s2 ON s2.k = t2 LEFT JOIN s3 ON s3.k = t3""",
        "candidate_scores": scored + " SELECT pensioner_id, place, vet_id, death_year, round(score, 6) AS score, f_last, f_first, f_death FROM sc",
        "decide_records": scored + """, rk AS (SELECT *, row_number() OVER (PARTITION BY pensioner_id ORDER BY round(score, 9) DESC, place) AS k FROM sc),
            t AS (SELECT pensioner_id, count(*) AS candidates, max(round(score, 9)) FILTER (WHERE k = 1) AS t, coalesce(max(round(score, 9)) FILTER (WHERE k = 2), 0) AS s, max(death_year) AS dy FROM rk GROUP BY pensioner_id),
            u AS (SELECT *, t - s AS g, CASE WHEN coalesce(dy, '') NOT IN ('', '0') THEN 0.7 ELSE 0.6 END AS th FROM t)
            SELECT pensioner_id, candidates, round(t, 6) AS top_score, round(s, 6) AS second_score, CASE WHEN t < 0.4 THEN 'low_score' WHEN t >= th AND (candidates = 1 OR g >= CAST(0.1 AS DOUBLE)) THEN 'auto_accept' ELSE 'needs_review' END AS status, round(g, 6) AS gap, CAST(th AS DOUBLE) AS threshold FROM u""",
        "top_candidates": scored + f", {r6} SELECT pensioner_id, vet_id, place, rank FROM (SELECT *, row_number() OVER (PARTITION BY pensioner_id ORDER BY s DESC, place) AS rank FROM sr) WHERE rank <= 20",
        "merged_candidates": scored + f", {r6} SELECT vet_id, s AS score, pensioner_id FROM (SELECT *, row_number() OVER (PARTITION BY vet_id ORDER BY s DESC, pensioner_id, place) AS k FROM sr) WHERE k = 1",
        "merged_strategies": f"""WITH {_copies_sql()}, x AS (SELECT pensioner_id, place, c.id AS vet_id, coalesce(c.source, '') AS source, coalesce(c.name, '') AS name FROM cop),
            f AS (SELECT vet_id, source, min(lpad(pensioner_id::VARCHAR, 12, '0') || lpad(place::VARCHAR, 6, '0')) AS o FROM x GROUP BY ALL)
            SELECT x.vet_id, arg_min(x.name, lpad(x.pensioner_id::VARCHAR, 12, '0') || lpad(x.place::VARCHAR, 6, '0')) AS name, (SELECT string_agg(f.source, '|' ORDER BY f.o) FROM f WHERE f.vet_id = x.vet_id) AS via FROM x GROUP BY x.vet_id""",
        "date_window": f"SELECT DISTINCT id, born, died FROM registry_vets WHERE ({year('born')} IS NULL OR {year('born')} BETWEEN 1810 AND 1880) AND ({year('died')} IS NULL OR {year('died')} BETWEEN 1861 AND 1955)",
        "outliers": f"""WITH {_records_sql()} SELECT pensioner_id, status, CASE WHEN coalesce(best_score,0) < 0.2 THEN '<0.20' WHEN best_score < 0.4 THEN '0.20-0.40' WHEN best_score < 0.6 THEN '0.40-0.60' WHEN best_score < 0.8 THEN '0.60-0.80' WHEN best_score < 0.95 THEN '0.80-0.95' ELSE '>=0.95' END AS bucket,
            CASE WHEN coalesce(fag_status, '') <> '' THEN fag_status WHEN coalesce(best_score,0) >= 0.85 THEN 'auto_accept' WHEN coalesce(best_score,0) >= 0.4 THEN 'needs_review' ELSE 'low_score' END AS derived FROM rec WHERE coalesce(status,'') IN ('no_results','error','captcha','not_run') OR coalesce(best_score, 0) < 0.4""",
        "year_and_unit_agreement": f"""WITH {_copies_sql()} SELECT pensioner_id, place, CASE WHEN {gap} IS NULL THEN 'unknown' WHEN {gap} = 0 THEN 'exact' WHEN {gap} <= 2 THEN 'close' WHEN {gap} <= 5 THEN 'near' ELSE 'far' END AS years,
            CASE WHEN len({st('regiment')}) > 0 AND len({st('c.unit')}) > 0 THEN list_has_any({st('regiment')}, {st('c.unit')}) END AS units FROM cop""",
        "duplicate_verdicts": f"""WITH {_copies_sql()}, s AS (SELECT pensioner_id, fag_status, CASE WHEN {low('pensioner_last')} = '' OR {low('pensioner_last')} <> {low('c.last_name')} THEN 0 WHEN {low('pensioner_first')} = '' OR {low('c.first_name')} = '' OR {low('pensioner_first')} <> {low('c.first_name')} THEN 1
            WHEN ({unit('regiment')} <> '' AND {unit('c.unit')} <> '' AND (contains({unit('c.unit')}, {unit('regiment')}) OR contains({unit('regiment')}, {unit('c.unit')}))) OR coalesce(abs(try_cast(trim(pensioner_birth_year) AS INTEGER) - try_cast(regexp_extract(coalesce(c.born,''), '\\b(\\d{{4}})\\b', 1) AS INTEGER)) <= 2, FALSE) THEN 3 ELSE 2 END AS r FROM cop),
            b AS (SELECT pensioner_id, max(r) AS r, max(fag_status) AS fs, count(*) AS candidates FROM s GROUP BY pensioner_id)
            SELECT pensioner_id, candidates, CASE r WHEN 3 THEN 'strong' WHEN 2 THEN 'medium' WHEN 1 THEN 'weak' ELSE 'none' END AS strength, CASE WHEN r >= 2 THEN CASE WHEN fs = 'auto_accept' THEN 'duplicate' ELSE 'follow_up_candidate' END WHEN r = 1 THEN 'clear' WHEN coalesce(fs,'') NOT IN ('no_results','error','') THEN 'clear' ELSE 'no_fag_match' END AS dedup_status FROM b""",
        "corroborated": f"""WITH {_copies_sql()}, x AS (SELECT pensioner_id, place, c.id AS vet_id, c.first_name AS f, c.last_name AS l, c.died AS died, c.state AS state FROM cop),
            p AS (SELECT a.pensioner_id, a.place AS place_a, b.place AS place_b, a.vet_id AS vet_a, b.vet_id AS vet_b, {soft} AS nm, {meet} AS yr, upper(coalesce(a.state,'')) <> '' AND upper(coalesce(a.state,'')) = upper(coalesce(b.state,'')) AS stt, coalesce(a.died,'') AS da, coalesce(b.died,'') AS db FROM x a JOIN x b ON a.pensioner_id = b.pensioner_id AND a.place < b.place),
            q AS (SELECT *, CASE WHEN NOT nm OR (da <> '' AND db <> '' AND NOT yr) THEN NULL WHEN yr AND stt THEN 0.95 WHEN yr THEN 0.80 WHEN stt THEN 0.70 WHEN (da <> '') <> (db <> '') THEN 0.60 END AS confidence FROM p)
            SELECT pensioner_id, place_a, place_b, vet_a, vet_b, CAST(confidence AS DOUBLE) AS confidence FROM (SELECT *, row_number() OVER (PARTITION BY pensioner_id ORDER BY place_a, place_b) AS k FROM q WHERE confidence IS NOT NULL) WHERE k = 1""",
        "duplicate_edges": f"WITH {edges} SELECT a, b FROM e",
        "canonical_persons": persons + " SELECT id, person_id, size FROM pers",
        "person_fields": persons + f""" SELECT p.person_id, {filled('m.first_name')} AS first_name, {filled('m.last_name')} AS last_name, {filled('m.spouse')} AS spouse, {filled('m.unit')} AS regiment,
            coalesce(CAST(arg_min({lead('m.born')}, m.id) FILTER (WHERE {lead('m.born')} IS NOT NULL) AS VARCHAR), '') AS birth_year, coalesce(CAST(arg_min({lead('m.died')}, m.id) FILTER (WHERE {lead('m.died')} IS NOT NULL) AS VARCHAR), '') AS death_year,
            coalesce(array_to_string(list_sort(list(DISTINCT m.cemetery_id) FILTER (WHERE m.cemetery_id IS NOT NULL)), ','), '') AS place_ids, count(*) AS source_count FROM reg m JOIN pers p ON p.id = m.id GROUP BY p.person_id""",
        "block_sizes": """WITH reg AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY vet_fetched_at NULLS FIRST, name NULLS FIRST) AS rn FROM registry_vets) WHERE rn = 1),
            w AS (SELECT id, list_filter(regexp_split_to_array(trim(coalesce(name,'')), '\\s+'), lambda x: x <> '') AS w FROM reg WHERE id IS NOT NULL)
            SELECT 'surname_prefix:' || lower(substr(w[len(w)], 1, 2)) AS block_key, count(DISTINCT id) AS n FROM w WHERE len(w) > 1 GROUP BY 1""",
        "status_counts": f"WITH {_records_sql()} SELECT count(*) AS total, " + ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in ("auto_accept", "needs_review", "low_score", "no_candidates", "error")) + " FROM rec",
    }
