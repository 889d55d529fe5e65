"""Search plans: ladders, templates, regions, refinement and ranking."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollweave.functions import text as T
from rollweave.plans import ladder, regional
from rollweave.session import table


def _people(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "results").select("pensioner_id", "pensioner_first", "pensioner_middle", "pensioner_last", "pensioner_birth_year", "pensioner_death_year", "regiment", "best_score", "status", "processed_at")
    return r.groupBy("pensioner_id").agg(F.min(F.struct("processed_at", *[c for c in r.columns if c not in ("pensioner_id", "processed_at")])).alias("r")).select("pensioner_id", "r.*")


def _person() -> dict:
    return ladder.person("pensioner_first", "pensioner_middle", "pensioner_last", "pensioner_birth_year", "pensioner_death_year", regiment="regiment")


_flat = lambda p: F.array_join(F.transform(F.array_sort(F.map_entries(p)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "&")


def ladder_all(spark: SparkSession, d: str) -> DataFrame:
    """All strategies on names and years that apply to each person, with their parameters."""
    rungs = {n: s for n, s in ladder.LADDER.items() if n not in ("F2-regiment-bio", "F3-nickname")}
    return ladder.run_ladder(_people(spark, d), "pensioner_id", _person(), rungs).select("pensioner_id", "strategy", _flat(F.col("params")).alias("params"))


def ladder_phrases(spark: SparkSession, d: str) -> DataFrame:
    """The strategies on regiment phrases and nicknames."""
    rungs = {n: ladder.LADDER[n] for n in ("F2-regiment-bio", "F3-nickname")}
    return ladder.run_ladder(_people(spark, d), "pensioner_id", _person(), rungs).select("pensioner_id", "strategy", _flat(F.col("params")).alias("params"))


def ladder_first(spark: SparkSession, d: str) -> DataFrame:
    """The first strategy of each person, as an address query with place and date filters."""
    first = ladder.run_ladder(_people(spark, d), "pensioner_id", _person(), mode="first")
    filtered = ladder.with_filters(F.col("params"), F.lit(""), {"locationId": "country_4"})
    return first.select("pensioner_id", "strategy", ladder.query_string(filtered).alias("query"))


TEMPLATES = {
    "T1": {"applies_when": ["first", "last"], "params": {"firstname": "{first}", "lastname": "{last}", "middlename?": "{middle}", "exactspelling": "true"}},
    "T2": {"applies_when": ["last"], "params": {"lastname": {"transform": "upper", "input": "{last}"}, "begin": {"transform": "slice", "input": "{last}", "args": [0, 3]}, "unit?": "{extra.regiment}", "window": {"value": 5}}},
}


def ladder_templates(spark: SparkSession, d: str) -> DataFrame:
    """Strategies compiled from declarative templates."""
    rungs = {n: ladder.compile_template(s) for n, s in TEMPLATES.items()}
    return ladder.run_ladder(_people(spark, d), "pensioner_id", _person(), rungs).select("pensioner_id", "strategy", _flat(F.col("params")).alias("params"))


def ladder_notices(spark: SparkSession, d: str) -> DataFrame:
    """Newspaper searches of each person."""
    p = ladder.person("pensioner_first", "pensioner_middle", "pensioner_last", "pensioner_birth_year", "pensioner_death_year", state=T.unit_state("regiment"))
    return ladder.run_ladder(_people(spark, d), "pensioner_id", p, ladder.NOTICES).select("pensioner_id", "strategy", _flat(F.col("params")).alias("params"))


def plans_regional(spark: SparkSession, d: str) -> DataFrame:
    """Geographic plans of each person, without those already done."""
    done = table(spark, d, "observations").where("kind = 'FaGCandidateFetch'").select("pensioner_id", F.lit("B4-fuzzy-last").alias("strategy"), F.lit("US").alias("state")).distinct()
    p = regional.regional_plans(_people(spark, d), "pensioner_id", "pensioner_last", "regiment", F.lit(""), "regiment", done)
    return p.select("pensioner_id", "strategy", "scope", "state", "place")


def plans_refined(spark: SparkSession, d: str) -> DataFrame:
    """Refinement plans of weak records, at most eight each."""
    p = regional.refinement_plans(_people(spark, d), "pensioner_id", "pensioner_last", "regiment", "best_score", "status", F.lit(False))
    return p.select("pensioner_id", "strategy", "state", "place")


def plans_ranked(spark: SparkSession, d: str) -> DataFrame:
    """Regional plans ranked by expected gain, the best three of each person."""
    people = _people(spark, d)
    plans = regional.regional_plans(people, "pensioner_id", "pensioner_last", "regiment", F.lit(""), "regiment").join(people.select("pensioner_id", "regiment"), "pensioner_id")
    scored = plans.withColumn("score", F.round(regional.plan_score("strategy", "scope", "reason", "regiment"), 6))
    return regional.rank_plans(scored, "pensioner_id", "score", 3).select("pensioner_id", "strategy", "scope", "score", "rank")


def likelihoods(spark: SparkSession, d: str) -> DataFrame:
    """Likeliest state of each regiment, and the calibrated probability of each record's score."""
    p = _people(spark, d)
    return p.select("pensioner_id", regional.state_likelihood("regiment")[0].alias("s"), F.round(regional.match_probability(F.coalesce("best_score", F.lit(0.0))), 6).alias("probability")).select("pensioner_id", "s.state", "s.p", "probability")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (ladder_all, ladder_phrases, ladder_first, ladder_templates, ladder_notices, plans_regional, plans_refined, plans_ranked, likelihoods)}


def oracle_sql() -> dict[str, str]:
    rec = "rec AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pensioner_id ORDER BY processed_at NULLS FIRST, pensioner_first NULLS FIRST) AS rn FROM results) WHERE rn = 1)"
    year = lambda c: f"CASE WHEN trim(coalesce({c}, '')) IN ('', '0') THEN '' ELSE trim({c}) END"
    per = f"{rec}, p AS (SELECT pensioner_id, coalesce(pensioner_first,'') AS f, coalesce(pensioner_middle,'') AS m, coalesce(pensioner_last,'') AS l, {year('pensioner_birth_year')} AS b, {year('pensioner_death_year')} AS d, coalesce(regiment,'') AS u, best_score, status FROM rec)"
    pairs = lambda *kv: "array_to_string(list_sort(list_filter([" + ", ".join(f"CASE WHEN coalesce({v}, '') <> '' THEN '{k}=' || {v} END" for k, v in kv) + "], lambda x: x IS NOT NULL)), '&')"
    named = "f <> '' AND l <> ''"
    whole = lambda y: f"CASE WHEN regexp_full_match({y}, '[0-9]+') THEN CAST({y} AS INTEGER) END"
    tmpl = "CASE WHEN f <> '' AND l <> '' THEN " + "array_to_string(list_filter(['exactspelling=true', 'firstname=' || f, 'lastname=' || l, CASE WHEN m <> '' THEN 'middlename=' || m END], lambda x: x IS NOT NULL), '&') END"
    tmpl2 = "array_to_string(list_filter(['begin=' || substr(l, 1, 3), 'lastname=' || upper(l), CASE WHEN u <> '' THEN 'unit=' || u END, 'window=5'], lambda x: x IS NOT NULL), '&')"
    origin = "CASE " + " ".join(f"WHEN contains(lower(u), '{k}') THEN '{v}'" for k, v in T.ORIGIN_STATES.items()) + " END"
    texas = " OR ".join(f"contains(lower(u), '{h}')" for h in regional.TEXAS_HINTS)
    plans = f"""{per}, o AS (SELECT *, {origin} AS org FROM p WHERE l <> ''),
        plan AS (SELECT pensioner_id, u, 'B1-exact' AS strategy, 'OK' AS scope, 'OK' AS state, 0 AS k FROM o UNION ALL SELECT pensioner_id, u, 'B1-exact', 'RegimentOrigin', org, 1 FROM o WHERE org IS NOT NULL AND org <> 'OK'
        UNION ALL SELECT pensioner_id, u, 'B1-exact', 'Texas', 'TX', 2 FROM o WHERE {texas} UNION ALL SELECT pensioner_id, u, 'B4-fuzzy-last', 'US', 'US', 3 FROM o),
        placed AS (SELECT *, row_number() OVER (PARTITION BY pensioner_id ORDER BY k) - 1 AS place FROM plan)"""
    refine = f"""{per}, o AS (SELECT *, coalesce(best_score, 0) AS s, coalesce(best_score, 0) < 0.4 OR coalesce(status,'') = 'no_candidates' AS weak, {origin} AS org FROM p WHERE l <> ''),
        x AS (SELECT pensioner_id, strategy, state, k FROM (SELECT o.*, unnest([{', '.join(f"{{'strategy': 'B1-exact', 'state': '{s}', 'k': {i}, 'w': 1}}" for i, s in enumerate(regional.SURROUNDING))}, {{'strategy': 'B4-fuzzy-last', 'state': 'US', 'k': 6, 'w': 1}}, {{'strategy': 'B3-first-initial-fuzzy', 'state': 'OK', 'k': 7, 'w': 2}}, {{'strategy': 'F3-nickname', 'state': 'OK', 'k': 8, 'w': 3}}, {{'strategy': 'B1-exact', 'state': '*', 'k': 9, 'w': 2}}]) AS q FROM o)
          CROSS JOIN LATERAL (SELECT q.strategy AS strategy, CASE WHEN q.state = '*' THEN org ELSE q.state END AS state, q.k AS k) WHERE CASE WHEN weak THEN q.w IN (1, 3) ELSE s < 0.85 AND q.w IN (2, 3) END AND (q.state <> '*' OR (org IS NOT NULL AND org <> 'OK'))),
        placed AS (SELECT *, row_number() OVER (PARTITION BY pensioner_id ORDER BY k) AS n FROM x)"""
    points = "CASE " + " ".join(f"WHEN s <= {x1} THEN " + (f"{y1}" if i == 0 else f"{p0[1]} + (s - {p0[0]}) / ({x1} - {p0[0]}) * ({y1} - {p0[1]})") for i, ((x1, y1), p0) in enumerate(zip(regional.MATCH_POINTS, [regional.MATCH_POINTS[0], *regional.MATCH_POINTS]))) + f" ELSE {regional.MATCH_POINTS[-1][1]} END"
    like = [(k, next(iter(v.items()))) for k, v in regional.STATE_PRIORS.items()]
    notice = lambda k, kw, a, b: f"SELECT pensioner_id, '{k}' AS strategy, " + pairs(("date-end", b), ("date-start", a), ("entity-types", f"'{ladder.ENTITY_TYPES}'"), ("keyword", kw), ("sort", "'score-desc'")) + " AS params FROM "
    return {
        "ladder_all": f"""WITH {per} SELECT pensioner_id, strategy, params FROM (
            SELECT pensioner_id, 'B1-exact' AS strategy, {pairs(('birthyear', 'b'), ('birthyearfilter', "CASE WHEN b <> '' THEN '1' END"), ('exactspelling', "'true'"), ('firstname', 'f'), ('lastname', 'l'), ('middlename', 'm'))} AS params FROM p WHERE {named}
            UNION ALL SELECT pensioner_id, 'B2-middle-initial', {pairs(('exactspelling', "'true'"), ('firstname', 'f'), ('lastname', 'l'), ('middlename', 'm'))} FROM p WHERE {named} AND length(m) = 1
            UNION ALL SELECT pensioner_id, 'B3-first-initial-fuzzy', {pairs(('birthyearfilter', "'5'"), ('firstname', "substr(f, 1, 1) || '*'"), ('fuzzyNames', "'true'"), ('lastname', 'l'))} FROM p WHERE {named}
            UNION ALL SELECT pensioner_id, 'B4-fuzzy-last', {pairs(('birthyearfilter', "'5'"), ('fuzzyNames', "'true'"), ('lastname', 'l'), ('middlename', 'm'))} FROM p WHERE l <> ''
            UNION ALL SELECT pensioner_id, 'B5-apostrophe', {pairs(('firstname', 'f'), ('fuzzyNames', "'true'"), ('lastname', "replace(l, '''', '')"))} FROM p WHERE {named} AND contains(l, '''')
            UNION ALL SELECT pensioner_id, 'C1-cw-context', {pairs(('firstname', 'f'), ('isVeteran', "'true'"), ('lastname', 'l'))} FROM p WHERE {named}
            UNION ALL SELECT pensioner_id, 'F1a-birth-year', {pairs(('birthyear', 'b'), ('birthyearfilter', "'5'"), ('exactspelling', "'true'"), ('firstname', 'f'), ('lastname', 'l'), ('middlename', 'm'))} FROM p WHERE {named} AND b <> ''
            UNION ALL SELECT pensioner_id, 'F1b-death-year', {pairs(('deathyear', 'd'), ('deathyearfilter', "CASE WHEN try_cast(d AS INTEGER) < 1930 THEN '10' ELSE '5' END"), ('exactspelling', "'true'"), ('firstname', 'f'), ('lastname', 'l'))} FROM p WHERE {named} AND regexp_full_match(d, '[0-9]+')
            UNION ALL SELECT pensioner_id, 'F1c-year-sniper', {pairs(('birthyear', 'b'), ('birthyearfilter', "'5'"), ('deathyear', 'd'), ('deathyearfilter', "'5'"), ('exactspelling', "'true'"), ('firstname', 'f'), ('lastname', 'l'), ('middlename', 'm'))} FROM p WHERE {named} AND b <> '' AND d <> ''
            UNION ALL SELECT pensioner_id, 'F1d-year-window', {pairs(('birthyear', 'b'), ('birthyearfilter', "CASE WHEN b <> '' THEN '5' END"), ('deathyear', 'd'), ('deathyearfilter', "CASE WHEN d <> '' THEN '5' END"), ('firstname', 'f'), ('fuzzyNames', "'true'"), ('lastname', 'l'), ('middlename', 'm'))} FROM p WHERE {named} AND (b <> '' OR d <> '')
            UNION ALL SELECT pensioner_id, 'F4-follow-up', {pairs(('birthyear', f"CAST({whole('b')} - 10 AS VARCHAR)"), ('birthyear_range', f"CASE WHEN {whole('b')} IS NOT NULL THEN '20' END"), ('deathyear', f"CAST({whole('d')} - 10 AS VARCHAR)"), ('deathyear_range', f"CASE WHEN {whole('d')} IS NOT NULL THEN '20' END"), ('fuzzy', "'true'"), ('lastname', 'l'))} FROM p WHERE l <> '')""",
        "ladder_templates": f"WITH {per} SELECT pensioner_id, 'T1' AS strategy, {tmpl} AS params FROM p WHERE {named} UNION ALL SELECT pensioner_id, 'T2', {tmpl2} FROM p WHERE l <> ''",
        "ladder_notices": f"""WITH {per}, q AS (SELECT *, {whole('b')} AS bi, {whole('d')} AS di FROM p),
            y AS (SELECT *, CAST(CASE WHEN bi IS NOT NULL THEN greatest(bi - 5, {ladder.YEARS[0]}) WHEN di IS NOT NULL THEN greatest(di - 30, {ladder.YEARS[0]}) ELSE {ladder.YEARS[0]} END AS VARCHAR) AS a1, CAST(CASE WHEN bi IS NOT NULL AND di IS NOT NULL THEN least(di + 5, {ladder.YEARS[1]}) WHEN bi IS NOT NULL THEN bi + 30 WHEN di IS NOT NULL THEN di + 5 ELSE {ladder.YEARS[1]} END AS VARCHAR) AS a2 FROM q),
            st AS (SELECT *, {_state_sql()} AS st FROM y)
            {notice('N1-keyword', "array_to_string(list_filter([f, m, l], lambda x: x <> ''), ' ')", 'a1', 'a2')} st WHERE f <> '' OR l <> '' UNION ALL {notice('N2-last', 'l', f"'{ladder.YEARS[0]}'", f"'{ladder.YEARS[1]}'")} st WHERE l <> '' UNION ALL {notice('N3-last-state', "l || ' ' || st", f"'{ladder.YEARS[0]}'", f"'{ladder.YEARS[1]}'")} st WHERE l <> '' AND st <> ''""",
        "plans_regional": f"WITH {plans} SELECT pensioner_id, strategy, scope, state, place FROM placed WHERE NOT (strategy = 'B4-fuzzy-last' AND pensioner_id IN (SELECT pensioner_id FROM observations WHERE kind = 'FaGCandidateFetch' AND pensioner_id IS NOT NULL))",
        "plans_refined": f"WITH {refine} SELECT pensioner_id, strategy, state, n - 1 AS place FROM placed WHERE n <= 8",
        "plans_ranked": f"""WITH {plans}, g AS (SELECT *, round(0.2 + CASE WHEN scope = 'OK' THEN 0.1 WHEN scope IN ('RegimentOrigin','Texas') AND u <> '' THEN 0.05 WHEN scope = 'US' THEN -0.05 ELSE 0 END, 6) AS score FROM placed),
            h AS (SELECT *, row_number() OVER (PARTITION BY pensioner_id, strategy, scope ORDER BY score DESC, place) AS n FROM g)
            SELECT pensioner_id, strategy, scope, CAST(score AS DOUBLE) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY pensioner_id ORDER BY score DESC, place) AS rank FROM h WHERE n = 1) WHERE rank <= 3""",
        "likelihoods": f"WITH {per}, z AS (SELECT *, coalesce(best_score, 0) AS s FROM p) SELECT pensioner_id, CASE " + " ".join(f"WHEN contains(lower(u), '{k}') THEN '{s}'" for k, (s, _) in like) + " ELSE 'OK' END AS state, CAST(CASE " + " ".join(f"WHEN contains(lower(u), '{k}') THEN {v}" for k, (_, v) in like) + f" ELSE 0.8 END AS DOUBLE) AS p, round(CAST({points} AS DOUBLE), 6) AS probability FROM z",
    }


def _state_sql() -> str:
    up = "upper(regexp_replace(u, '\\bCo\\.', 'Co', 'g'))"
    named = "CASE " + " ".join(f"WHEN contains({up}, '{k}') THEN '{v}'" for k, v in T.STATE_NAMES.items()) + " ELSE '' END"
    return f"coalesce(list_extract(list_filter(regexp_extract_all({up}, '\\b({'|'.join(T.STATE_CODES)})\\b'), lambda x: x <> 'CO'), 1), {named})"
