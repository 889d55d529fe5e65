"""References without records, and nested records as flat tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollweave.operators.nested import Layout, element_table, plan_layout, schema_graph, shred, struct_tables
from rollweave.operators.references import Reference, Target, number_key, orphan_report, orphans, slug_key
from rollweave.session import table

SPELLING = {"memorialId": "memorial_id", "memorialID": "memorial_id", "MemorialId": "memorial_id"}


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """References of work_observations and label_snapshots whose target was not there."""
    c = F.col
    links, labels = table(spark, d, "work_observations"), table(spark, d, "label_snapshots")
    references = [
        Reference("work_observations", "observation_id", links, c("link_id"), slug_key(c("observation_id")), c("linked_at"), "observations"),
        Reference("work_observations", "work_id", links, c("link_id"), slug_key(c("work_id")), c("linked_at"), "work_items"),
        Reference("label_snapshots", "ground_truth_memorial_id", labels, c("label_id"), number_key(c("ground_truth_memorial_id")), c("extracted_at"), "memorial_cache"),
    ]
    targets = [
        Target("observations", table(spark, d, "observations"), slug_key(c("observation_id")), start=c("recorded_at")),
        Target("work_items", table(spark, d, "work_items"), slug_key(c("work_id")), end=c("deleted_at")),
        Target("memorial_cache", table(spark, d, "memorial_cache"), number_key(c("memorial_id")), start=c("cached_at"), end=c("removed_at")),
    ]
    return orphans(references, targets)


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphans per table, field and month."""
    return orphan_report(p3_found(spark, d))


def _fetches(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "observations").where("kind = 'FaGCandidateFetch'").select("observation_id", "payload")


def _layout(spark: SparkSession, d: str) -> Layout:
    graph = [(r["parent"], r["child"], r["kind"], r["repeated"]) for r in schema_graph(_fetches(spark, d), "payload").collect()]
    return plan_layout(graph, SPELLING, implied=(("pages", "candidates"),))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Candidates, family members and registry copies as flat rows with their place."""
    people = shred(_fetches(spark, d), "observation_id", "payload", _layout(spark, d), "memorial_id", keep_fields=False)
    people = people.where("element in ('candidates', 'family') and child_id <> ''")
    copies = struct_tables(table(spark, d, "results"), "pensioner_id", "cgr_records")["cgr_records"].where("id is not null")
    flat = people.select(F.lit("observations").alias("parent_table"), "parent_id", "path", "child_id")
    return flat.unionByName(copies.select(F.lit("results").alias("parent_table"), "parent_id", "path", F.col("id").cast("string").alias("child_id"))).distinct()


def p4_candidates(spark: SparkSession, d: str) -> DataFrame:
    """The table of candidates: their page, and all that is inlined into them."""
    layout = _layout(spark, d)
    return element_table(shred(_fetches(spark, d), "observation_id", "payload", layout, "memorial_id"), layout, "candidates").distinct()


def p4_family(spark: SparkSession, d: str) -> DataFrame:
    """The table of family members of any depth, with the path of the candidate or member they belong to."""
    layout = _layout(spark, d)
    return element_table(shred(_fetches(spark, d), "observation_id", "payload", layout, "memorial_id"), layout, "family").distinct()


def p4_copies(spark: SparkSession, d: str) -> DataFrame:
    """The table of registry copies, with the record they belong to."""
    return struct_tables(table(spark, d, "results"), "pensioner_id", "cgr_records")["cgr_records"].distinct()


def p4_schema(spark: SparkSession, d: str) -> DataFrame:
    """The edges of the schema graph of the fetched candidates."""
    return schema_graph(_fetches(spark, d), "payload")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p3_found, p3_report, p4_found, p4_candidates, p4_family, p4_copies, p4_schema)}


_ORPHANS = r"""
WITH refs AS (
  SELECT DISTINCT * FROM (
    SELECT 'work_observations' AS ref_table, 'observation_id' AS ref_field, 'observations' AS ns, link_id AS row_id, lower(regexp_replace(observation_id, '\s+', '', 'g')) AS k, linked_at AS made FROM work_observations
    UNION ALL SELECT 'work_observations', 'work_id', 'work_items', link_id, lower(regexp_replace(work_id, '\s+', '', 'g')), linked_at FROM work_observations
    UNION ALL SELECT 'label_snapshots', 'ground_truth_memorial_id', 'memorial_cache', label_id,
      CASE WHEN lower(ground_truth_memorial_id) LIKE '%memorial/%' THEN regexp_extract(lower(ground_truth_memorial_id), 'memorial/0*(\d+)', 1)
           WHEN regexp_extract(ground_truth_memorial_id, '0*(\d+)', 1) <> '' THEN regexp_extract(ground_truth_memorial_id, '0*(\d+)', 1) ELSE lower(trim(ground_truth_memorial_id)) END, extracted_at FROM label_snapshots)
  WHERE k IS NOT NULL AND k <> ''),
there AS (
  SELECT 'observations' AS ns, lower(regexp_replace(observation_id, '\s+', '', 'g')) AS k, recorded_at AS s, NULL::TIMESTAMP AS e FROM observations
  UNION ALL SELECT 'work_items', lower(regexp_replace(work_id, '\s+', '', 'g')), TIMESTAMP '0001-01-01', deleted_at FROM work_items
  UNION ALL SELECT 'memorial_cache', regexp_extract(memorial_id, '0*(\d+)', 1), cached_at, removed_at FROM memorial_cache),
found AS (
  SELECT ref_table, ref_field, row_id, strftime(made, '%Y-%m') AS period FROM refs r
  WHERE NOT EXISTS (SELECT 1 FROM there t WHERE t.ns = r.ns AND t.k = r.k AND t.s <= r.made AND (t.e IS NULL OR t.e > r.made)))
"""


def oracle_sql() -> dict[str, str]:
    kept = "id, name, unit, born, first_name, middle_name, last_name, source, company, died, spouse, cemetery_id, cemetery_name, county, state, vet_fetched_at"
    return {
        "p4_copies": f"SELECT DISTINCT CAST(pensioner_id AS VARCHAR) AS parent_id, CAST(i - 1 AS VARCHAR) AS path, '' AS parent_path, {', '.join('c.' + x.strip() for x in kept.split(','))} FROM (SELECT pensioner_id, unnest(cgr_records) AS c, generate_subscripts(cgr_records, 1) AS i FROM results) WHERE c IS NOT NULL",
        "p3_found": _ORPHANS + "SELECT DISTINCT * FROM found",
        "p3_report": _ORPHANS + "SELECT ref_table, ref_field, period, count(*) AS orphans FROM (SELECT DISTINCT * FROM found) GROUP BY ALL",
    }
