"""Final rows and exports: state rows, linked-data records, security events, record diffs, ordered passes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollweave.functions import text as T
from rollweave.functions.text import ColumnLike
from rollweave.operators.scoring import status_of_score

SCHEMA_VERSION = 2


def display_name(last: ColumnLike, first: ColumnLike) -> Column:
    """"Last, First", without a stray comma where one is missing."""
    return F.regexp_replace(F.concat(T.text(last), F.lit(", "), T.text(first)), r"^[, ]+|[, ]+$", "")


def badges(found: dict[str, Column]) -> Column:
    """The names of the evidence that is there."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), n) for n, c in found.items()]))


def state_rows(rows: DataFrame, key: str, name: Column, status: str, score: str, candidates: str, evidence: dict[str, Column], keep: list[str], engine: str, policy: str = "1") -> DataFrame:
    """One projected row per record: identity, decision, candidates, badges, versions and the engine-neutral form."""
    common = F.struct(F.col(key).alias("id"), name.alias("title"), F.lit(engine).alias("engine"), F.col(status).alias("status"), F.col(score).alias("best_score"), F.col(candidates).alias("candidates"))
    return rows.select(key, name.alias("name"), status, score, F.col(candidates).alias("ranked_candidates"), badges(evidence).alias("badges"), *keep, F.lit(policy).alias("_policy_version"), F.lit(SCHEMA_VERSION).alias("_schema_version"), common.alias("common"))


def common_candidate(ident: ColumnLike, title: ColumnLike, url: ColumnLike, score: Column, attributes: dict[str, ColumnLike]) -> Column:
    """A candidate in the engine-neutral form, absent attributes left out."""
    pairs = [F.struct(F.lit(k).alias("k"), T.text(v).alias("v")) for k, v in attributes.items()]
    return F.struct(T.text(ident).alias("id"), T.text(title).alias("title"), T.text(url).alias("url"), score.alias("score"), F.map_from_entries(F.filter(F.array(*pairs), lambda p: p["v"] != "")).alias("attributes"))


# fixed values: vocabularies of the linked-data export
CONTEXT = {"dcterms": "http://purl.org/dc/terms/", "schema": "https://schema.org/", "prov": "http://www.w3.org/ns/prov#"}


def linked_data(rows: DataFrame, key: str, fields: dict[str, ColumnLike], run: str, policy: str, see_also: list[Column], generated: Column) -> DataFrame:
    """``key, record``: a JSON-LD person per row. Null links are left out, and so is the list if it is empty."""
    context = F.struct(*[F.lit(v).alias(k) for k, v in CONTEXT.items()])
    links = F.array_compact(F.array(*see_also)) if see_also else F.array().cast("array<string>")
    record = F.struct(
        context.alias("@context"), F.lit("Person").alias("@type"), F.concat(F.lit("urn:rollweave:record:"), F.col(key).cast("string")).alias("@id"),
        *[T.text(v).alias(k) for k, v in fields.items()],
        F.lit(f"run:{run}").alias("prov:wasGeneratedBy"), F.lit(f"policy:v{policy}").alias("prov:wasAttributedTo"), F.date_format(generated, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("prov:generatedAtTime"),
        F.when(F.size(links) > 0, links).alias("sameAs"),
    )
    return rows.select(key, F.to_json(record).alias("record"))


def entity_link(qid: ColumnLike) -> Column:
    """The address of a knowledge-base item, null unless the id is Q and digits."""
    q = F.trim(T.text(qid))
    return F.when(q.rlike(r"^Q\d+$"), F.concat(F.lit("http://www.wikidata.org/entity/"), q))


# fixed values: event -> (class, activity); names of the classes
EVENT_CLASSES = {"work_claimed": (1006, 1), "pensioner_start": (1006, 1), "work_completed": (1006, 3), "pensioner_end": (1006, 3), "strategy_ran": (1006, 2), "strategy_skipped": (1006, 2), "strategy_error": (1006, 2), "observation_appended": (1006, 2), "run_summary": (1006, 2), "cooldown_set": (7003, 2), "bot_wall_observed": (2004, 1)}
CLASS_NAMES = {1006: "Scheduled Job Activity", 2004: "Detection Finding", 7003: "Process Remediation Activity"}


def security_events(events: DataFrame, kind: str, at: Column, details: dict[str, ColumnLike]) -> DataFrame:
    """Events in the open security schema: class, activity, time in milliseconds and a job, remediation or finding. Unknown kinds are dropped."""
    table = F.create_map(*[x for k, (c, a) in EVENT_CLASSES.items() for x in (F.lit(k), F.struct(F.lit(c).alias("c"), F.lit(a).alias("a")))])
    names = F.create_map(*[x for k, v in CLASS_NAMES.items() for x in (F.lit(k), F.lit(v))])
    e = events.withColumn("_m", F.try_element_at(table, F.col(kind))).where("_m is not null")
    detail = F.map_filter(F.map_from_entries(F.array(*[F.struct(F.lit(k).alias("k"), T.text(v).alias("v")) for k, v in details.items()])), lambda k, v: v != "")
    part = F.when(F.col("_m.c") == 1006, "job").when(F.col("_m.c") == 7003, "remediation").otherwise("finding_info")
    return e.select(F.col("_m.c").alias("class_uid"), F.element_at(names, F.col("_m.c")).alias("class_name"), F.col("_m.a").alias("activity_id"), F.unix_millis(at).alias("time"), part.alias("part"), F.to_json(detail).alias("detail"))


def replay(rows: DataFrame, key: str, score: str, status: str, floor: float, accept: float = 0.85) -> DataFrame:
    """``key, before, after, changed``: the status each stored score would have under other thresholds."""
    after = status_of_score(F.coalesce(F.col(score), F.lit(0.0)), None, floor, accept)
    return rows.select(key, F.col(status).alias("before"), after.alias("after"), (~F.col(status).eqNullSafe(after)).alias("changed"))


def changed_fields(before: dict[str, Column], after: dict[str, Column]) -> Column:
    """The names of the fields that differ, null being a value."""
    return F.array_compact(F.array(*[F.when(~before[k].eqNullSafe(after[k]), k) for k in before]))


Pass = Callable[[DataFrame], DataFrame]


def run_passes(rows: DataFrame, passes: list[tuple[str, Pass]]) -> tuple[DataFrame, dict[str, str]]:
    """Ordered passes over the rows; one that cannot be planned is left out, and its error is returned by name."""
    failed: dict[str, str] = {}
    for name, step in passes:
        try:
            rows = rows.transform(step)
        except Exception as e:  # noqa: BLE001 - a pass must not take the others down
            failed[name] = f"{type(e).__name__}: {e}"[:300]
    return rows, failed


def unify(rows: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Two generations of a schema as one: each field is the first of its aliases that exists and is filled."""
    there = set(rows.columns)
    return rows.select(*[T.first_filled(*[a for a in names if a in there]).alias(field) if any(a in there for a in names) else F.lit("").alias(field) for field, names in aliases.items()])
