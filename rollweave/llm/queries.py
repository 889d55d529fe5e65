"""Queries of the llm operators, by name, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollweave.llm import canonical, entities, fusion, groups, leakage, names, people, spam, tokens
from rollweave.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Rows of results and open_gravestones that name the same person."""
    rows = people.results_people(table(spark, d, "results")).unionByName(people.gravestone_people(table(spark, d, "open_gravestones")))
    return names.link_names(people.person_features(rows, table(spark, d, "regiments")))


def p2_confidence(spark: SparkSession, d: str) -> DataFrame:
    """Matches between results and the registry, with their confidence."""
    regiments = table(spark, d, "regiments")
    left = people.person_features(people.results_people(table(spark, d, "results")), regiments)
    right = people.person_features(people.registry_people(table(spark, d, "registry_vets")), regiments)
    return entities.match_sources(left, right).select(F.col("left_id").alias("pensioner_id"), F.col("right_id").alias("vet_id"), "confidence")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """The pairs of p2_confidence."""
    return p2_confidence(spark, d).select("pensioner_id", "vet_id").distinct()


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Records in accepted pairs, with the smallest record of their group."""
    c = F.col
    pairs = groups.accepted_pairs(table(spark, d, "match_pairs"), c("ref_a"), c("ref_b"), c("verdict"), c("decided_at"), c("pair_id"))
    return groups.connected_groups(pairs, "u", "v")


def _copies(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "results").select("pensioner_id", F.explode("cgr_records").alias("r")).where("r.id is not null")
    return rows.select("pensioner_id", F.col("r.id").alias("vet_id"), F.col("r.unit").alias("unit"), F.col("r.born").alias("born"), F.col("r.cemetery_id").alias("cemetery_id"), F.col("r.source").alias("source"), F.to_timestamp(F.regexp_replace(F.regexp_replace("r.vet_fetched_at", "Z$", ""), "T", " ")).alias("fetched"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """The surviving unit, birth and cemetery of each veteran copied for several pensioners."""
    copies = _copies(spark, d).join(table(spark, d, "vet_sources").groupBy("source").agg(F.max("trust").alias("trust")), "source", "left")
    places = table(spark, d, "cemeteries").select("cemetery_id").distinct().withColumn("known_place", F.lit(True))
    copies = copies.join(places, "cemetery_id", "left")
    fetched = F.coalesce(F.col("fetched"), F.lit("0001-01-01").cast("timestamp"))
    fields = {
        "unit": ("unit", fusion.known(F.col("unit")), [F.coalesce(F.col("trust"), F.lit(0)), fetched]),
        "born": ("born", fusion.known(F.col("born")), [fusion.birth_precision(F.col("born")), fetched]),
        "cemetery_id": ("cemetery_id", F.coalesce(F.col("known_place"), F.lit(False)), [fetched]),
    }
    best = fusion.survive(copies, "vet_id", fields, several="pensioner_id")
    return best.select("vet_id", F.coalesce("unit", F.lit("")).alias("unit"), F.coalesce("born", F.lit("")).alias("born"), F.coalesce("cemetery_id", F.lit(0)).alias("cemetery_id"))


def p6_fused(spark: SparkSession, d: str) -> DataFrame:
    """Unit, birth and cemetery of each veteran by Bayesian fusion with copy detection, with the posterior of each."""
    fused = fusion.fuse(_copies(spark, d), "vet_id", ["unit", "born", "cemetery_id"], "source")
    return fused.select("vet_id", "field", "value", F.round("posterior", 6).alias("posterior"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """The listed regiments that each typed regiment names."""
    results = table(spark, d, "results").select(F.col("pensioner_id").alias("rid"), F.col("regiment").alias("typed"))
    exports = table(spark, d, "open_gravestones").select(F.col("export_id").alias("rid"), F.col("schema_regiment").alias("typed"))
    found = canonical.map_to_list(results.unionByName(exports), "rid", "typed", table(spark, d, "regiments"), "regiment_id", "canonical_name", "state", "unit_number", "branch", "aka")
    return found.select("record_id", F.col("entry_id").alias("regiment_id"))


def p7_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Records whose regiment is none of the list."""
    return p7_found(spark, d).where("regiment_id = 0").select("record_id")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """Every document's text as token ids of byte_bpe_50k."""
    return tokens.encode_corpus(table(spark, d, "documents"), "doc_id", "text")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """The test items that leaked, with the documents that carry them."""
    return leakage.leaked(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "text").select("item_id", "doc_id")


def p9_clean(spark: SparkSession, d: str) -> DataFrame:
    """The documents left after the affected ones are removed."""
    documents = table(spark, d, "documents").select("doc_id", "text")
    found = leakage.leaked(documents, "doc_id", "text", table(spark, d, "eval_items"), "item_id", "text")
    return leakage.without_leaks(documents.select("doc_id"), "doc_id", found)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Pages made mostly of stuffed keywords, tags or links."""
    return spam.stuffed_pages(table(spark, d, "documents"), "doc_id", "text").select("doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p2_found, p2_confidence, p5_found, p6_found, p6_fused, p7_found, p7_unmatched, p8_ids, p9_found, p9_clean, p10_found)}


_ACCEPTED = """
WITH RECURSIVE said AS (
  SELECT least(lower(trim(ref_a)), lower(trim(ref_b))) AS u, greatest(lower(trim(ref_a)), lower(trim(ref_b))) AS v, lower(trim(verdict)) AS verdict,
         row_number() OVER (PARTITION BY least(lower(trim(ref_a)), lower(trim(ref_b))), greatest(lower(trim(ref_a)), lower(trim(ref_b))) ORDER BY decided_at DESC NULLS LAST, pair_id DESC) AS n
  FROM match_pairs WHERE ref_a IS NOT NULL AND ref_b IS NOT NULL AND trim(ref_a) <> '' AND trim(ref_b) <> '' AND lower(trim(ref_a)) <> lower(trim(ref_b))),
edge AS (SELECT u, v FROM said WHERE n = 1 AND verdict = 'match'),
both_ways AS (SELECT u AS a, v AS b FROM edge UNION SELECT v, u FROM edge),
reach(ref, seen) AS (SELECT DISTINCT a, a FROM both_ways UNION SELECT r.ref, e.b FROM reach r JOIN both_ways e ON r.seen = e.a)
"""

_UNKNOWN = ", ".join("'" + w.replace("'", "''") + "'" for w in fusion.UNKNOWN)


def oracle_sql() -> dict[str, str]:
    known = lambda x: f"({x} IS NOT NULL AND lower(regexp_replace({x}, '^[\\s()\\[\\]]+|[\\s()\\[\\]]+$', '', 'g')) NOT IN ({_UNKNOWN}))"
    month = "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*[.]?"
    precision = f"""CASE WHEN NOT regexp_matches(lower(trim(born)), '[0-9]{{4}}') OR regexp_matches(trim(born), '^[^0-9]*0000[^0-9]*$') THEN 0
      WHEN regexp_matches(lower(trim(born)), '[?]|\\b(about|abt|ca|circa|c|est|estimated|approx|before|after|bef|aft|between|or)\\b') THEN 1
      WHEN regexp_matches(lower(trim(born)), '\\b[0-9]{{1,2}}\\s+{month}\\s+[0-9]{{4}}\\b|{month}\\s+[0-9]{{1,2}},?\\s+[0-9]{{4}}\\b|\\b[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}\\b') THEN 4
      WHEN regexp_matches(lower(trim(born)), '{month}\\s+[0-9]{{4}}\\b|\\b[0-9]{{4}}-[0-9]{{1,2}}\\b') THEN 3 ELSE 2 END"""
    return {
        "p5_found": _ACCEPTED + "SELECT ref, min(seen) AS group_ref FROM reach GROUP BY ref",
        "p6_found": f"""
WITH copies AS (
  SELECT r.pensioner_id, c.id AS vet_id, c.unit AS unit, c.born AS born, c.cemetery_id AS cemetery_id, coalesce(s.trust, 0) AS trust,
         coalesce(try_cast(replace(regexp_replace(c.vet_fetched_at, 'Z$', ''), 'T', ' ') AS TIMESTAMP), TIMESTAMP '0001-01-01') AS fetched
  FROM (SELECT pensioner_id, unnest(cgr_records) AS c FROM results) r LEFT JOIN vet_sources s ON r.c.source = s.source WHERE r.c.id IS NOT NULL),
several AS (SELECT vet_id FROM copies GROUP BY vet_id HAVING count(DISTINCT pensioner_id) > 1),
unit AS (SELECT vet_id, unit, row_number() OVER (PARTITION BY vet_id ORDER BY trust DESC, fetched DESC, unit DESC) AS n FROM copies WHERE {known('unit')}),
born AS (SELECT vet_id, born, row_number() OVER (PARTITION BY vet_id ORDER BY {precision} DESC, fetched DESC, born DESC) AS n FROM copies WHERE {known('born')}),
place AS (SELECT vet_id, cemetery_id, row_number() OVER (PARTITION BY vet_id ORDER BY fetched DESC, cemetery_id DESC) AS n FROM copies WHERE cemetery_id IN (SELECT cemetery_id FROM cemeteries))
SELECT v.vet_id, coalesce(u.unit, '') AS unit, coalesce(b.born, '') AS born, coalesce(p.cemetery_id, 0) AS cemetery_id
FROM several v LEFT JOIN unit u ON u.vet_id = v.vet_id AND u.n = 1 LEFT JOIN born b ON b.vet_id = v.vet_id AND b.n = 1 LEFT JOIN place p ON p.vet_id = v.vet_id AND p.n = 1
""",
    }
