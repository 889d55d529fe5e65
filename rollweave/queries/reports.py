"""Analytics, learning, the log, and exports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollweave.functions import text as T
from rollweave.operators import analytics, learning, merge, projection, state
from rollweave.queries.names import STRATEGY, unwrapped_sql
from rollweave.session import table


def _labels(spark: SparkSession, d: str) -> DataFrame:
    """Latest reviewed label of each pensioner with the record's best score."""
    labels = learning.latest_labels(table(spark, d, "label_snapshots"), "pensioner_id", "extracted_at", ["label_id", "human_review_decision"])
    scores = table(spark, d, "results").groupBy("pensioner_id").agg(F.max("best_score").alias("score"))
    return labels.join(scores, "pensioner_id").where("score is not null").select("pensioner_id", "human_review_decision", (F.col("human_review_decision") == "accepted").alias("accepted"), F.round("score", 4).alias("score"))


def label_confusion(spark: SparkSession, d: str) -> DataFrame:
    """Confusion counts and rates of accepting scores from .7 on."""
    c = learning.confusion(_labels(spark, d), "accepted", "score", 0.7)
    return c.select("tp", "fp", "fn", "tn", *[F.round(x, 6).alias(x) for x in ("precision", "recall", "f1", "accuracy")])


def label_sweep(spark: SparkSession, d: str) -> DataFrame:
    """Confusion at every candidate threshold."""
    s = learning.threshold_sweep(_labels(spark, d), "accepted", "score")
    return s.select(F.round("threshold", 6).alias("threshold"), "tp", "fp", "fn", "tn", F.round("f1", 6).alias("f1"))


def label_best_threshold(spark: SparkSession, d: str) -> DataFrame:
    """The threshold with the best F1."""
    b = learning.best_threshold(learning.threshold_sweep(_labels(spark, d), "accepted", "score"))
    return b.select(F.round("threshold", 6).alias("threshold"), F.round("f1", 6).alias("f1"))


def label_deciles(spark: SparkSession, d: str) -> DataFrame:
    """Mean score and acceptance of tenths by score."""
    return learning.deciles(_labels(spark, d), "accepted", "score")


def label_calibration(spark: SparkSession, d: str) -> DataFrame:
    """Coefficients of the linear calibration."""
    return learning.linear_calibration(_labels(spark, d), "accepted", "score").select(F.round("a", 6).alias("a"), F.round("b", 6).alias("b"))


def label_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Labels per decision, reviewed or not."""
    return analytics.histogram(_labels(spark, d), F.col("human_review_decision"), "decision")


def work_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Outcome and duration of work items per knowledge source."""
    w = table(spark, d, "work_items")
    begun = F.to_timestamp(F.regexp_replace(F.regexp_replace(F.try_element_at("attempts", F.lit(1))["leased_at"], "Z$", ""), "T", " "))
    return analytics.source_metrics(w, "knowledge_source", "state", begun, F.col("completed_at"))


def work_states(spark: SparkSession, d: str) -> DataFrame:
    """Work items per source and state."""
    return table(spark, d, "work_items").groupBy("knowledge_source", "state").agg(F.count(F.lit(1)).alias("n"))


def work_claimable(spark: SparkSession, d: str) -> DataFrame:
    """Work items that can be claimed at a given time, with the wait after their last failure."""
    now = F.lit("2026-01-01 00:00:00").cast("timestamp")
    w = state.claimable(table(spark, d, "work_items"), "state", "not_before", "lease_deadline_at", now)
    return w.select("work_id", "state", "attempt", state.backoff_seconds(F.col("attempt")).alias("wait_s"), state.state_after_failure(F.col("attempt")).alias("if_failed"))




CANDIDATE = '"via_strategies"'  # a field that each candidate has once


def _fetches(spark: SparkSession, d: str) -> DataFrame:
    """Run, strategy, record and candidates of each fetch, whole and damaged payloads alike."""
    rows = table(spark, d, "observations").where("kind = 'FaGCandidateFetch'").select("observation_id", "recorded_at", "pensioner_id", "run_id", "payload")
    once = state.first_per_id(rows, "observation_id", ["recorded_at"]).withColumn("payload", T.unwrapped_json("payload"))
    fetched = once.select("run_id", F.regexp_extract("payload", STRATEGY, 1).alias("strategy"), "pensioner_id", F.regexp_count("payload", F.lit(CANDIDATE)).alias("candidates"))
    return fetched.where("strategy <> ''")


def _strategy_stats(spark: SparkSession, d: str) -> DataFrame:
    accepted = table(spark, d, "results").where("status = 'auto_accept'").select("pensioner_id")
    return analytics.strategy_stats(_fetches(spark, d), "run_id", "strategy", "pensioner_id", "candidates", accepted)


def strategy_runs(spark: SparkSession, d: str) -> DataFrame:
    """Per run and strategy: fires, candidates, records touched and accepted."""
    s = _strategy_stats(spark, d)
    return s.select("run_id", "strategy", "fires", "candidates", F.round("avg_candidates", 6).alias("avg_candidates"), "touched", "accepted", F.round("success_rate", 6).alias("success_rate"))


def strategy_overall(spark: SparkSession, d: str) -> DataFrame:
    """Strategies over all runs: counts summed, rates averaged."""
    a = analytics.across_runs(_strategy_stats(spark, d), "strategy")
    return a.select("strategy", "runs", "fires", "candidates", "touched", "accepted", F.round("mean_success_rate", 6).alias("mean_success_rate"))


def run_summary(spark: SparkSession, d: str) -> DataFrame:
    """Totals, done and outliers of all result rows."""
    return analytics.outcome_summary(table(spark, d, "results"), "status", "best_score")


def run_report(spark: SparkSession, d: str) -> DataFrame:
    """Score buckets and field completeness of all result rows."""
    return analytics.run_report(table(spark, d, "results"), "best_score", ["pensioner_birth_year", "pensioner_death_year", "regiment", "company"])


def decade_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Registry rows per decade of birth."""
    return analytics.histogram(table(spark, d, "registry_vets"), (F.floor(T.year_anywhere("born") / 10) * 10).cast("int"), "decade")


def ambiguous_names(spark: SparkSession, d: str) -> DataFrame:
    """Registry names that stand for several ids."""
    return analytics.ambiguous_keys(table(spark, d, "registry_vets").withColumn("name", T.trim_lower("name")), "name", "id")


def coverage_tiers(spark: SparkSession, d: str) -> DataFrame:
    """Which kind of data each record offers first, with cumulative coverage."""
    filled = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    return analytics.first_hit(table(spark, d, "results"), {"both years": filled("pensioner_birth_year") & filled("pensioner_death_year"), "a year": filled("pensioner_birth_year") | filled("pensioner_death_year"), "regiment": filled("regiment"), "name": filled("pensioner_name")})


def run_comparison(spark: SparkSession, d: str) -> DataFrame:
    """First and last row of each pensioner compared as two runs."""
    r = table(spark, d, "results").select("pensioner_id", "processed_at", "status", F.round("best_score", 6).alias("best_score"), "fag_status")
    old = r.groupBy("pensioner_id").agg(F.min(F.struct("processed_at", "status", "best_score", "fag_status")).alias("r")).select("pensioner_id", "r.*")
    new = r.where("status <> 'error'").groupBy("pensioner_id").agg(F.max(F.struct("processed_at", "status", "best_score", "fag_status")).alias("r")).select("pensioner_id", "r.*")
    c = merge.compare_runs(old, new, "pensioner_id", ["status", "best_score", "fag_status"])
    return c.select("pensioner_id", "side", F.array_join("changed", ",").alias("changed"))


def log_once(spark: SparkSession, d: str) -> DataFrame:
    """The log without re-deliveries, counted per kind."""
    o = table(spark, d, "observations").select("observation_id", "recorded_at", "kind")
    return state.first_per_id(o, "observation_id", ["recorded_at"]).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.min("recorded_at").alias("first_at"), F.max("recorded_at").alias("last_at"))


def log_latest(spark: SparkSession, d: str) -> DataFrame:
    """The latest observation of each pensioner and kind."""
    return state.last_per_key(table(spark, d, "observations"), ["pensioner_id", "kind"], "recorded_at", "observation_id", ["observation_id"])


def log_since(spark: SparkSession, d: str) -> DataFrame:
    """Observations after a cursor."""
    o = table(spark, d, "observations").select("observation_id", "recorded_at").distinct()
    return state.since(o, "recorded_at", "observation_id", "2026-01-01 00:00:00", "")


def resume_set(spark: SparkSession, d: str) -> DataFrame:
    """Pensioners without a label yet."""
    return state.resume(table(spark, d, "results").select("pensioner_id").distinct(), table(spark, d, "label_snapshots"), "pensioner_id")


def record_issues(spark: SparkSession, d: str) -> DataFrame:
    """Integrity issues of result rows."""
    r = table(spark, d, "results").withColumn("issues", state.integrity_issues(None, {"no_app_number": F.coalesce(F.trim("pensioner_app_number"), F.lit("")) == "", "no_name": F.coalesce(F.trim("pensioner_name"), F.lit("")) == "", "no_registry": F.size("cgr_records") <= 0, "null_copy": F.exists("cgr_records", lambda c: c["id"].isNull())}))
    return r.where(F.size("issues") > 0).select("pensioner_id", F.array_join("issues", ",").alias("issues")).distinct()


def id_problems(spark: SparkSession, d: str) -> DataFrame:
    """Labels' pensioners that are missing from the results, and repeated or unlabelled result rows."""
    return state.id_coverage(table(spark, d, "results"), table(spark, d, "label_snapshots").select("pensioner_id"), "pensioner_id")


def score_replay(spark: SparkSession, d: str) -> DataFrame:
    """Statuses under another threshold, counted by change."""
    return projection.replay(table(spark, d, "results"), "pensioner_id", "best_score", "status", 0.5).groupBy("before", "after", "changed").agg(F.count(F.lit(1)).alias("n"))


def export_records(spark: SparkSession, d: str) -> DataFrame:
    """Linked-data records of all exports; the fields are read back from the JSON."""
    o = table(spark, d, "open_gravestones")
    fields = {"dcterms:title": "dcterms_title", "schema:givenName": "schema_givenname", "schema:familyName": "schema_familyname", "schema:birthDate": "schema_birthdate"}
    rec = projection.linked_data(o, "export_id", fields, "r1", "2", [], F.col("prov_generatedattime"))
    j = F.from_json("record", "`@id` string, `dcterms:title` string, `schema:givenName` string, `schema:familyName` string, `prov:generatedAtTime` string")
    return rec.select("export_id", j.alias("j")).select("export_id", F.col("j.`@id`").alias("urn"), F.col("j.`dcterms:title`").alias("title"), F.col("j.`schema:givenName`").alias("given"), F.col("j.`schema:familyName`").alias("family"), F.col("j.`prov:generatedAtTime`").alias("generated"))


def security_log(spark: SparkSession, d: str) -> DataFrame:
    """Work items as security events, counted by class and activity."""
    w = table(spark, d, "work_items").select("work_id", F.explode("attempts").alias("a"), "knowledge_source").select("work_id", "knowledge_source", F.lit("work_claimed").alias("event"), F.to_timestamp(F.regexp_replace(F.regexp_replace("a.leased_at", "Z$", ""), "T", " ")).alias("at"))
    e = projection.security_events(w, "event", F.col("at"), {"name": "work_id", "knowledge_source": "knowledge_source"})
    return e.groupBy("class_uid", "class_name", "activity_id", "part").agg(F.count(F.lit(1)).alias("n"), F.min("time").alias("first_ms"), F.max("time").alias("last_ms"))


def event_windows(spark: SparkSession, d: str) -> DataFrame:
    """Events and values per hour and type (the batch form of the stream's windows)."""
    e = table(spark, d, "events")
    return e.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def nested_registry(spark: SparkSession, d: str) -> DataFrame:
    """The flat registry nested by cemetery and flattened again."""
    from rollweave.sources.readers import nested_groups

    v = table(spark, d, "registry_vets").select("cemetery_id", "cemetery_name", "county", "id", "name").where("cemetery_id is not null").distinct()
    n = nested_groups(v, "cemetery_id", ["cemetery_name", "county"], "id", ["id", "name"], "veterans")
    return n.select("cemetery_id", "cemetery_name", F.size("veterans").alias("n"), F.array_join(F.transform("veterans", lambda x: x["id"].cast("string")), ",").alias("ids"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            label_confusion, label_sweep, label_best_threshold, label_deciles, label_calibration, label_decisions, work_metrics, work_states, work_claimable, strategy_runs, strategy_overall, run_summary, run_report, decade_histogram, ambiguous_names, coverage_tiers,
            run_comparison, log_once, log_latest, log_since, resume_set, record_issues, id_problems, score_replay, export_records, security_log, event_windows, nested_registry,
        )
    }


def oracle_sql() -> dict[str, str]:
    lab = """lab AS (SELECT l.pensioner_id, l.human_review_decision, l.human_review_decision = 'accepted' AS y, round(s.score, 4) AS score FROM (SELECT *, row_number() OVER (PARTITION BY pensioner_id ORDER BY extracted_at DESC, label_id DESC, human_review_decision DESC) AS n FROM label_snapshots) l
      JOIN (SELECT pensioner_id, max(best_score) AS score FROM results GROUP BY 1) s ON s.pensioner_id = l.pensioner_id WHERE l.n = 1 AND s.score IS NOT NULL)"""
    rates = "CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS p, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS r"
    f1 = "CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END"
    sweep = f"""{lab}, d AS (SELECT DISTINCT score AS s FROM lab), t AS (SELECT s AS th FROM d UNION SELECT s + (lead(s) OVER (ORDER BY s) - s) / 2 FROM d UNION SELECT CAST(0 AS DOUBLE) UNION SELECT CAST(1 AS DOUBLE)),
      c AS (SELECT th, count(*) FILTER (WHERE y AND score >= th) AS tp, count(*) FILTER (WHERE NOT y AND score >= th) AS fp, count(*) FILTER (WHERE y AND score < th) AS fn, count(*) FILTER (WHERE NOT y AND score < th) AS tn FROM t, lab WHERE th IS NOT NULL GROUP BY th), q AS (SELECT *, {rates} FROM c), z AS (SELECT *, {f1} AS f1 FROM q)"""
    ts = "try_cast(replace(regexp_replace({}, 'Z$', ''), 'T', ' ') AS TIMESTAMP)"
    once = f"once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY observation_id ORDER BY recorded_at, pensioner_id) AS n FROM observations WHERE kind = 'FaGCandidateFetch') WHERE n = 1), p AS (SELECT run_id, pensioner_id, {unwrapped_sql('payload')} AS payload FROM once), f AS (SELECT run_id, regexp_extract(payload, '{STRATEGY}', 1) AS strategy, len(regexp_extract_all(payload, '{CANDIDATE}')) AS candidates, pensioner_id FROM p)"
    stats = f"{once}, k AS (SELECT run_id, strategy, pensioner_id, count(*) AS fires, sum(candidates) AS candidates, bool_or(pensioner_id IN (SELECT pensioner_id FROM results WHERE status = 'auto_accept')) AS ok FROM f WHERE strategy IS NOT NULL AND strategy <> '' GROUP BY ALL), st AS (SELECT run_id, strategy, CAST(sum(fires) AS BIGINT) AS fires, CAST(sum(candidates) AS BIGINT) AS candidates, count(*) AS touched, count(*) FILTER (WHERE ok) AS accepted FROM k GROUP BY ALL)"
    full = lambda c: f"round(100.0 * avg(CASE WHEN trim(coalesce({c}, '')) <> '' THEN 1.0 ELSE 0 END), 2)"
    filled = lambda c: f"trim(coalesce({c}, '')) <> ''"
    tier = f"CASE WHEN {filled('pensioner_birth_year')} AND {filled('pensioner_death_year')} THEN 0 WHEN {filled('pensioner_birth_year')} OR {filled('pensioner_death_year')} THEN 1 WHEN {filled('regiment')} THEN 2 WHEN {filled('pensioner_name')} THEN 3 END"
    out = "(coalesce(status, '') IN ('no_results','error','captcha','not_run') OR coalesce(best_score, 0) < 0.4)"
    return {
        "label_confusion": f"WITH {lab}, c AS (SELECT count(*) FILTER (WHERE y AND score >= 0.7) AS tp, count(*) FILTER (WHERE NOT y AND score >= 0.7) AS fp, count(*) FILTER (WHERE y AND score < 0.7) AS fn, count(*) FILTER (WHERE NOT y AND score < 0.7) AS tn FROM lab), q AS (SELECT *, {rates} FROM c) SELECT tp, fp, fn, tn, round(p, 6) AS precision, round(r, 6) AS recall, round({f1}, 6) AS f1, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy FROM q",
        "label_sweep": f"WITH {sweep} SELECT round(th, 6) AS threshold, tp, fp, fn, tn, round(f1, 6) AS f1 FROM z",
        "label_best_threshold": f"WITH {sweep} SELECT round(th, 6) AS threshold, round(f1, 6) AS f1 FROM z ORDER BY z.f1 DESC, th LIMIT 1",
        "label_deciles": f"WITH {lab}, o AS (SELECT score, y, row_number() OVER (ORDER BY score, y) AS rn, count(*) OVER () AS n FROM lab) SELECT CAST((10 * rn - 1) // n AS INTEGER) AS bucket, round(avg(score), 3) AS avg_score, round(avg(CASE WHEN y THEN 1.0 ELSE 0 END), 3) AS avg_accepted FROM o GROUP BY 1",
        "label_calibration": f"WITH {lab}, s AS (SELECT covar_pop(CASE WHEN y THEN 1.0 ELSE 0 END, score) AS c, var_pop(score) AS v, avg(score) AS x, avg(CASE WHEN y THEN 1.0 ELSE 0 END) AS m FROM lab) SELECT round(CASE WHEN v < 0.0001 THEN 0 ELSE ln(greatest(m, 0.01) / greatest(1 - m, 0.01)) - c / v * x END, 6) AS a, round(CASE WHEN v < 0.0001 THEN 0 ELSE c / v END, 6) AS b FROM s",
        "label_decisions": f"WITH {lab} SELECT human_review_decision AS decision, count(*) AS n FROM lab GROUP BY 1",
        "work_metrics": f"""WITH d AS (SELECT knowledge_source, state, epoch(completed_at) - epoch({ts.format("attempts[1].leased_at")}) AS d FROM work_items), o AS (SELECT knowledge_source, list_sort(list(d) FILTER (WHERE d IS NOT NULL)) AS l FROM d GROUP BY 1)
            SELECT d.knowledge_source, count(*) AS items, count(*) FILTER (WHERE state = 'succeeded') AS succeeded, count(*) FILTER (WHERE state = 'retryable') AS retryable, round(CASE WHEN count(*) FILTER (WHERE state IN ('succeeded','terminal','blocked')) = 0 THEN 0 ELSE count(*) FILTER (WHERE state = 'succeeded') / count(*) FILTER (WHERE state IN ('succeeded','terminal','blocked')) END, 6) AS success_rate,
            round(avg(d), 4) AS avg_s, round(any_value(l[CAST(least(floor(0.95 * len(l)), len(l) - 1) AS INTEGER) + 1]), 4) AS p95_s FROM d JOIN o ON o.knowledge_source = d.knowledge_source GROUP BY d.knowledge_source""",
        "work_states": "SELECT knowledge_source, state, count(*) AS n FROM work_items GROUP BY ALL",
        "work_claimable": "SELECT work_id, state, attempt, CAST(least(pow(2, attempt), 60) AS INTEGER) AS wait_s, CASE WHEN attempt >= 3 THEN 'terminal' ELSE 'retryable' END AS if_failed FROM work_items WHERE (state IN ('ready','retryable') AND coalesce(not_before <= TIMESTAMP '2026-01-01', TRUE)) OR (state = 'leased' AND coalesce(lease_deadline_at < TIMESTAMP '2026-01-01', FALSE))",
        "strategy_runs": f"WITH {stats} SELECT run_id, strategy, fires, candidates, round(candidates / fires, 6) AS avg_candidates, touched, accepted, round(accepted / touched, 6) AS success_rate FROM st",
        "strategy_overall": f"WITH {stats} SELECT strategy, count(*) AS runs, CAST(sum(fires) AS BIGINT) AS fires, CAST(sum(candidates) AS BIGINT) AS candidates, CAST(sum(touched) AS BIGINT) AS touched, CAST(sum(accepted) AS BIGINT) AS accepted, round(avg(accepted / touched), 6) AS mean_success_rate FROM st GROUP BY strategy",
        "run_summary": f"SELECT count(*) AS total, count(*) FILTER (WHERE NOT {out}) AS done, count(*) FILTER (WHERE {out}) AS outliers, round(100.0 * count(*) FILTER (WHERE {out}) / count(*), 1) AS outlier_pct FROM results",
        "run_report": "SELECT 'completeness' AS section, item, CAST(value AS DOUBLE) AS value FROM (UNPIVOT (SELECT " + ", ".join(f"CAST({full(c)} AS DOUBLE) AS {c}" for c in ("pensioner_birth_year", "pensioner_death_year", "regiment", "company")) + " FROM results) ON COLUMNS(*) INTO NAME item VALUE value) UNION ALL SELECT 'score', CASE WHEN coalesce(best_score,0) < 0.2 THEN '<0.20' WHEN best_score < 0.4 THEN '0.20-0.40' WHEN best_score < 0.6 THEN '0.40-0.60' WHEN best_score < 0.8 THEN '0.60-0.80' WHEN best_score < 0.95 THEN '0.80-0.95' ELSE '>=0.95' END, CAST(count(*) AS DOUBLE) FROM results GROUP BY ALL",
        "decade_histogram": "SELECT CAST(floor(try_cast(regexp_extract(coalesce(born, ''), '(\\d{4})', 1) AS INTEGER) / 10) * 10 AS INTEGER) AS decade, count(*) AS n FROM registry_vets GROUP BY 1",
        "ambiguous_names": "SELECT lower(trim(coalesce(name, ''))) AS name, count(DISTINCT id) AS n FROM registry_vets GROUP BY 1 HAVING count(DISTINCT id) > 1",
        "coverage_tiers": f"WITH c AS (SELECT {tier} AS i, count(*) AS n FROM results GROUP BY 1), t AS (SELECT * FROM (VALUES (0, 'both years'), (1, 'a year'), (2, 'regiment'), (3, 'name')) v(i, tier)) SELECT tier, coalesce(n, 0) AS n, CAST(sum(coalesce(n, 0)) OVER (ORDER BY t.i) AS BIGINT) AS cumulative FROM t LEFT JOIN c ON c.i = t.i",
        "run_comparison": """WITH r AS (SELECT pensioner_id, processed_at, status, round(best_score, 6) AS best_score, fag_status FROM results), o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pensioner_id ORDER BY processed_at NULLS FIRST, status NULLS FIRST) AS n FROM r) WHERE n = 1), w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pensioner_id ORDER BY processed_at DESC NULLS LAST, status DESC NULLS LAST) AS n FROM r WHERE status <> 'error') WHERE n = 1)
            SELECT coalesce(o.pensioner_id, w.pensioner_id) AS pensioner_id, CASE WHEN w.pensioner_id IS NULL THEN 'old' WHEN o.pensioner_id IS NULL THEN 'new' ELSE 'both' END AS side, CASE WHEN w.pensioner_id IS NULL OR o.pensioner_id IS NULL THEN '' ELSE array_to_string(list_filter([CASE WHEN o.status IS DISTINCT FROM w.status THEN 'status' END, CASE WHEN o.best_score IS DISTINCT FROM w.best_score THEN 'best_score' END, CASE WHEN o.fag_status IS DISTINCT FROM w.fag_status THEN 'fag_status' END], lambda x: x IS NOT NULL), ',') END AS changed FROM o FULL JOIN w ON o.pensioner_id = w.pensioner_id""",
        "log_once": "SELECT kind, count(*) AS n, min(recorded_at) AS first_at, max(recorded_at) AS last_at FROM (SELECT *, row_number() OVER (PARTITION BY observation_id ORDER BY recorded_at, kind) AS n FROM observations) WHERE n = 1 GROUP BY kind",
        "log_latest": "SELECT pensioner_id, kind, recorded_at, observation_id FROM (SELECT *, row_number() OVER (PARTITION BY pensioner_id, kind ORDER BY recorded_at DESC, observation_id DESC) AS n FROM observations) WHERE n = 1",
        "log_since": "SELECT DISTINCT observation_id, recorded_at FROM observations WHERE recorded_at > TIMESTAMP '2026-01-01' OR (recorded_at = TIMESTAMP '2026-01-01' AND observation_id > '')",
        "resume_set": "SELECT DISTINCT pensioner_id FROM results WHERE pensioner_id NOT IN (SELECT pensioner_id FROM label_snapshots WHERE pensioner_id IS NOT NULL)",
        "record_issues": "SELECT DISTINCT pensioner_id, issues FROM (SELECT pensioner_id, array_to_string(list_filter([CASE WHEN trim(coalesce(pensioner_app_number, '')) = '' THEN 'no_app_number' END, CASE WHEN trim(coalesce(pensioner_name, '')) = '' THEN 'no_name' END, CASE WHEN len(cgr_records) = 0 THEN 'no_registry' END, CASE WHEN len(list_filter(cgr_records, lambda x: x.id IS NULL)) > 0 THEN 'null_copy' END], lambda x: x IS NOT NULL), ',') AS issues FROM results) WHERE issues <> ''",
        "id_problems": "WITH c AS (SELECT pensioner_id, count(*) AS n FROM results GROUP BY 1), e AS (SELECT DISTINCT pensioner_id FROM label_snapshots) SELECT * FROM (SELECT coalesce(c.pensioner_id, e.pensioner_id) AS pensioner_id, CASE WHEN c.n IS NULL THEN 'missing' WHEN e.pensioner_id IS NULL THEN 'unexpected' WHEN c.n > 1 THEN 'repeated' END AS problem FROM c FULL JOIN e ON c.pensioner_id = e.pensioner_id) WHERE problem IS NOT NULL",
        "score_replay": "SELECT before, after, before IS DISTINCT FROM after AS changed, count(*) AS n FROM (SELECT status AS before, CASE WHEN coalesce(best_score,0) >= 0.85 THEN 'auto_accept' WHEN coalesce(best_score,0) >= 0.5 THEN 'needs_review' ELSE 'low_score' END AS after FROM results) GROUP BY ALL",
        "export_records": "SELECT export_id, 'urn:rollweave:record:' || export_id AS urn, coalesce(dcterms_title, '') AS title, coalesce(schema_givenname, '') AS given, coalesce(schema_familyname, '') AS family, strftime(prov_generatedattime, '%Y-%m-%dT%H:%M:%SZ') AS generated FROM open_gravestones",
        "security_log": f"SELECT 1006 AS class_uid, 'Scheduled Job Activity' AS class_name, 1 AS activity_id, 'job' AS part, count(*) AS n, min(epoch_ms(t)) AS first_ms, max(epoch_ms(t)) AS last_ms FROM (SELECT {ts.format('a.leased_at')} AS t FROM (SELECT unnest(attempts) AS a FROM work_items))",
        "event_windows": "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
        "nested_registry": "WITH v AS (SELECT DISTINCT cemetery_id, cemetery_name, county, id, name FROM registry_vets WHERE cemetery_id IS NOT NULL) SELECT cemetery_id, arg_min(cemetery_name, id) AS cemetery_name, CAST(count(*) AS INTEGER) AS n, string_agg(id::VARCHAR, ',' ORDER BY id) AS ids FROM v GROUP BY cemetery_id",
    }
