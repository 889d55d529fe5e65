"""Match verdicts between records, corroboration across sources, and duplicate persons of one registry."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollweave.functions import text as T
from rollweave.functions.phonetic import first_name_similarity
from rollweave.functions.text import ColumnLike
from rollweave.operators.components import components

# fixed values: the states whose code is looked for in unit texts
UNIT_STATES = ["AL", "MS", "TN", "TX", "GA", "FL", "AR", "SC", "NC", "VA", "LA", "KY", "MO", "MD", "OK", "IN"]


def strength_bucket(last_score: Column, first_score: Column, has_last: Column, has_first: Column) -> Column:
    """``strong, medium, weak, none`` of a name comparison, from the scores of its parts."""
    best = F.greatest(last_score, first_score)
    lone = F.when(last_score >= 0.95, "medium").otherwise("weak")
    return F.when(~has_last | (last_score < 0.80), "none").when(~has_first, lone).when(best >= 0.95, "strong").when(best >= 0.80, "medium").otherwise("weak")


def year_bucket(a: ColumnLike, b: ColumnLike) -> Column:
    """``exact, close, near, far`` for years 0, up to 2, up to 5 or more apart; ``unknown`` if one is missing."""
    gap = F.abs(T.year_anywhere(a) - T.year_anywhere(b))
    return F.when(gap.isNull(), "unknown").when(gap == 0, "exact").when(gap <= 2, "close").when(gap <= 5, "near").otherwise("far")


def units_agree(a: ColumnLike, b: ColumnLike) -> Column:
    """Whether two units name a state in common; null if either names none."""

    def states(x: ColumnLike) -> Column:
        up = F.upper(T.text(x))
        return F.array_compact(F.array(*[F.when(up.rlike(rf"\b{s}\b"), s) for s in UNIT_STATES]))

    return F.when((F.size(states(a)) > 0) & (F.size(states(b)) > 0), F.arrays_overlap(states(a), states(b)))


def registry_verdict(name_strength: Column, unit_a: ColumnLike, unit_b: ColumnLike, year_a: ColumnLike, year_b: ColumnLike) -> Column:
    """The verdict on a registry row: none without a name, weak for two conflicts, medium for one or unknown years, strong for close years."""
    years = year_bucket(year_a, year_b)
    conflict = F.coalesce(~units_agree(unit_a, unit_b), F.lit(False)) & (T.text(unit_a) != "") & (T.text(unit_b) != "")
    far = years == "far"
    return F.when(name_strength == "none", "none").when(conflict & far, "weak").when(conflict | far, "medium").when(years.isin("exact", "close"), "strong").otherwise("medium")


def duplicate_strength(last_a: ColumnLike, first_a: ColumnLike, unit_a: ColumnLike, birth_a: ColumnLike, last_b: ColumnLike, first_b: ColumnLike, unit_b: ColumnLike, birth_b: ColumnLike) -> Column:
    """``strong`` for equal names with a unit or birth in common, ``medium`` for equal names, ``weak`` for the surname alone."""
    la, lb, fa, fb = (T.trim_lower(x) for x in (last_a, last_b, first_a, first_b))
    ua, ub = T.plain_unit(unit_a), T.plain_unit(unit_b)
    same_unit = (ua != "") & (ub != "") & (F.contains(ub, ua) | F.contains(ua, ub))
    near = F.abs(F.trim(T.text(birth_a)).try_cast("int") - T.year_word(birth_b)) <= 2
    return F.when((la == "") | (la != lb), "none").when((fa == "") | (fb == "") | (fa != fb), "weak").when(same_unit | F.coalesce(near, F.lit(False)), "strong").otherwise("medium")


def strength_rank(strength: ColumnLike) -> Column:
    """3 for strong, 2 for medium, 1 for weak, 0 for none."""
    s = T._c(strength)
    return F.when(s == "strong", 3).when(s == "medium", 2).when(s == "weak", 1).otherwise(0)


def duplicate_status(best: Column, search_status: ColumnLike, has_search_rows: Column) -> Column:
    """What a record's best registry match means beside its search: duplicate, follow_up_candidate, clear or no_fag_match."""
    status = T.text(search_status)
    searched = has_search_rows | ~status.isin("no_results", "error", "")
    return F.when(best.isin("strong", "medium"), F.when(status == "auto_accept", "duplicate").otherwise("follow_up_candidate")).when(best == "weak", "clear").when(searched, "clear").otherwise("no_fag_match")


def soft_name_match(first_a: ColumnLike, last_a: ColumnLike, first_b: ColumnLike, last_b: ColumnLike) -> Column:
    """Surnames equal or alike in three letters, and first names equal or with the same initial."""
    fa, la, fb, lb = (T.normalise(x) for x in (first_a, last_a, first_b, last_b))
    alike = (F.length(la) > 2) & (F.length(lb) > 2) & (F.startswith(la, F.substring(lb, 1, 3)) | F.startswith(lb, F.substring(la, 1, 3)))
    first = (fa == fb) | (fa != "") & (fb != "") & (F.substring(fa, 1, 1) == F.substring(fb, 1, 1))
    return (la != "") & (lb != "") & ((la == lb) | alike) & first


def years_meet(a: ColumnLike, b: ColumnLike, tolerance: int = 2) -> Column:
    """Whether any years of the two texts lie within the tolerance."""
    return F.exists(T.years_all(a), lambda x: F.exists(T.years_all(b), lambda y: F.abs(x - y) <= tolerance))


def corroboration(name_match: Column, died_a: ColumnLike, died_b: ColumnLike, state_a: ColumnLike, state_b: ColumnLike) -> Column:
    """Confidence that two sources mean one person: .95, .80, .70 or .60; null if names differ, years conflict or nothing supports it."""
    da, db = T.text(died_a), T.text(died_b)
    year = years_meet(died_a, died_b)
    sa, sb = F.upper(T.text(state_a)), F.upper(T.text(state_b))
    state = (sa != "") & (sa == sb)
    conflict = (da != "") & (db != "") & ~year
    one = (da != "") != (db != "")
    return F.when(~name_match | conflict, None).when(year & state, 0.95).when(year, 0.80).when(state, 0.70).when(one, 0.60)


def first_corroborated(pairs: DataFrame, key: str, registry_rank: str, candidate_rank: str, confidence: str) -> DataFrame:
    """Per record the first corroborated pair, by registry place and then by candidate rank."""
    w = Window.partitionBy(key).orderBy(registry_rank, candidate_rank)
    return pairs.where(F.col(confidence).isNotNull()).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def same_person_edges(registry: DataFrame, key: str, first: str, last: str, born: str, died: str, cemetery: str, unit: str, rank: str, least: float = 0.90) -> DataFrame:
    """``a, b``: pairs of registry rows with the same surname, alike first names and a tiebreaker in common.

    Only rows that share surname and a tiebreaker are compared: each tiebreaker is an equi-join key of its own (years by
    overlapping bands), so a hot surname does not meet itself in all pairs.
    """
    r = registry.select(
        F.col(key).alias("id"), T.fold_accents(first).alias("f"), T.fold_accents(last).alias("l"), T.year_leading(born).alias("born"), T.year_leading(died).alias("died"),
        F.col(cemetery).cast("string").alias("place"), T.fold_accents(unit).alias("unit"), T.fold_accents(rank).alias("rank"),
    ).where("id is not null and f <> '' and l <> ''").dropDuplicates(["id"])
    none = F.array().cast("array<string>")

    def bands(tag: str, c: str) -> Column:
        band = lambda d: F.concat(F.lit(tag), F.floor((F.col(c) + d) / 3).cast("string"))
        return F.when(F.col(c).isNotNull(), F.array_distinct(F.array(band(-1), band(1)))).otherwise(none)

    tag = lambda t, c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.array(F.concat(F.lit(t), F.col(c)))).otherwise(none)
    keyed = r.withColumn("tie", F.explode(F.concat(bands("b", "born"), bands("d", "died"), tag("p", "place"), tag("u", "unit"), tag("r", "rank"))))
    x, y = keyed.alias("x"), keyed.alias("y")
    c = lambda n: F.col(n)
    near = lambda n: F.coalesce(F.abs(c(f"x.{n}") - c(f"y.{n}")) <= 2, F.lit(False))
    equal = lambda n: F.coalesce((c(f"x.{n}") == c(f"y.{n}")) & (c(f"x.{n}") != ""), F.lit(False))
    tied = reduce(lambda p, q: p | q, [near("born"), near("died"), equal("place"), equal("unit"), equal("rank")])
    met = (c("x.l") == c("y.l")) & (c("x.tie") == c("y.tie")) & (c("x.id") < c("y.id")) & tied
    pairs = x.join(y, met).select(c("x.id").alias("a"), c("y.id").alias("b"), c("x.f").alias("fa"), c("y.f").alias("fb")).distinct()
    names = pairs.select("fa", "fb").distinct().where((F.col("fa") == F.col("fb")) | (first_name_similarity("fa", "fb") >= least))
    return pairs.join(names, ["fa", "fb"]).select("a", "b")


def canonical_persons(registry: DataFrame, key: str, edges: DataFrame) -> DataFrame:
    """``id, person_id, size``: each registry row with the person it belongs to, named by the smallest id."""
    found = components(edges, "a", "b").withColumnRenamed("id", key)
    all_ = registry.where(F.col(key).isNotNull()).select(key).distinct().join(found, key, "left")
    named = all_.select(F.col(key).alias("id"), F.coalesce("component", F.col(key)).alias("root"))
    sizes = named.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    return named.join(sizes, "root").select("id", F.concat(F.lit("person_"), F.col("root").cast("string")).alias("person_id"), "size")


def merged_fields(members: DataFrame, group: str, order: str, texts: dict[str, str], years: dict[str, str], ids: str) -> DataFrame:
    """Per group the first filled value of each text field, the first year of each date field, all ids and the row count."""
    first = lambda value: F.min(F.when(value.isNotNull() & (value.cast("string") != ""), F.struct(F.col(order), value.alias("v")))).getField("v")
    aggs = [F.coalesce(first(F.trim(F.col(c))), F.lit("")).alias(n) for n, c in texts.items()]
    aggs += [F.coalesce(first(T.year_leading(c)).cast("string"), F.lit("")).alias(n) for n, c in years.items()]
    return members.groupBy(group).agg(*aggs, F.array_sort(F.collect_set(ids)).alias("place_ids"), F.count(F.lit(1)).alias("source_count"))


def spouse_strength(local_first: ColumnLike, local_last: ColumnLike, found_first: ColumnLike, found_last: ColumnLike, strict: bool = False) -> Column:
    """``strong`` if both names of the spouses are equal, ``medium`` for the surname (unless strict); null if neither, or if a name is missing."""
    a, b, x, y = (T.spouse_name(c) for c in (local_first, local_last, found_first, found_last))
    there = (a != "") & (b != "") & (x != "") & (y != "")
    return F.when(there & (a == x) & (b == y), "strong").when(there & (b == y) & F.lit(not strict), "medium")


def tiered_join(left: DataFrame, right: DataFrame, tiers: list[tuple[str, str]], value: dict[str, str], order: str) -> DataFrame:
    """``left`` with ``value`` columns filled, where blank, from ``right`` by the first tier of keys that finds a row.

    ``tiers``: (left key, right key), blank keys never match; of rows with the same key the last by ``order`` counts.
    """
    out = left
    for i, (lk, rk) in enumerate(tiers):
        columns = [F.max_by(F.col(r), F.col(order)).alias(f"_{i}_{n}") for n, r in value.items()]
        side = right.where(F.coalesce(F.trim(rk), F.lit("")) != "").groupBy(F.trim(rk).alias(f"_k{i}")).agg(*columns, F.lit(True).alias(f"_hit{i}"))
        out = out.join(side, F.trim(out[lk]) == side[f"_k{i}"], "left")
    hits = [F.when(F.col(f"_hit{i}"), F.lit(i)) for i in range(len(tiers))]
    tier = F.coalesce(*hits)
    chosen = {n: F.coalesce(*[F.when(tier == i, F.col(f"_{i}_{n}").cast("string")) for i in range(len(tiers))]) for n in value}
    filled = {n: F.coalesce(F.nullif(F.trim(F.col(n).cast("string")), F.lit("")), c, F.lit("")) if n in left.columns else F.coalesce(c, F.lit("")) for n, c in chosen.items()}
    return out.select(*[c for c in left.columns if c not in value], *[c.alias(n) for n, c in filled.items()], tier.alias("tier"))
