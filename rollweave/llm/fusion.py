"""Best representative of each duplicate group.

``fuse`` is Bayesian fusion with copy detection: source accuracies and the dependence between sources
are estimated from the claims, votes that look copied are discounted, and per field the value with the
largest posterior survives. ``survive`` is the rule-based choice: per field a preference order over the
claims. Where an order is prescribed (a trust list, precision, recency) no posterior can promise to
reproduce it, so the query with prescribed answers uses ``survive``; see README.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollweave.session import cut

# fixed values: entries that only say that nothing is known
UNKNOWN = ["", "-", "--", "?", "??", "n/a", "na", "n.a.", "none", "null", "nil", "unknown", "unk", "unk.", "not known", "not stated", "not given", "unspecified", "tbd", "0", "00", "000", "0000", "0000-00-00", "00/00/0000", "nan", "no data", "missing", "blank", "illegible", "x", "xx", "xxx", "."]


PRESUMED = 0.95  # probability that a value two sources share is true, before any estimate


def known(text: Column) -> Column:
    """Whether a value says something: not null, blank, or a word for nothing known."""
    return F.coalesce(~F.lower(F.regexp_replace(text, r"^[\s\p{Z}()\[\]]+|[\s\p{Z}()\[\]]+$", "")).isin(UNKNOWN), F.lit(False))


def birth_precision(text: Column) -> Column:
    """4 for a full date, 3 for month and year, 2 for a year, 1 for an approximate year, 0 for what holds no year."""
    t = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    month = r"(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?"
    approximate = t.rlike(r"\?|\b(?:about|abt|ca|circa|c|est|estimated|approx|before|after|bef|aft|between|or)\b|^[c~]\s*\.?\s*\d") | t.rlike(r"\d{4}\s*[/-]\s*\d{2}$") & ~t.rlike(r"^\d{4}-(?:0[1-9]|1[0-2])$")
    return (
        F.when(~t.rlike(r"\d{4}") | t.rlike(r"^\D*0000\D*$"), 0)
        .when(approximate, 1)
        .when(t.rlike(rf"\b\d{{1,2}}(?:st|nd|rd|th)?\s+{month},?\s+\d{{4}}\b|{month}\s+\d{{1,2}}(?:st|nd|rd|th)?,?\s+\d{{4}}\b|\b\d{{4}}-\d{{1,2}}-\d{{1,2}}\b|\b\d{{1,2}}[/.]\d{{1,2}}[/.]\d{{4}}\b"), 4)
        .when(t.rlike(rf"{month},?\s+\d{{4}}\b|\b\d{{4}}[-/]\d{{1,2}}\b|\b\d{{1,2}}[/.]\d{{4}}\b"), 3)
        .otherwise(2)
    )


def survive(claims: DataFrame, group: str, fields: dict[str, tuple[str, Column, list[Column]]], several: str | None = None) -> DataFrame:
    """``group`` and one surviving value per field: the valid claim that comes first in the field's order.

    ``fields``: result name -> (claimed column, whether a claim is valid, preferences, the largest
    first). Ties in all preferences go to the larger value, so the result does not depend on row order.
    A group without a valid claim keeps its row with null. Null groups give no row. With ``several``, only groups with more than one
    value of that column are given. One aggregation with map-side combine: a group with a third of all rows costs no more than any other.
    """
    best = []
    for name, (column, valid, order) in fields.items():
        order_cols = [p.alias(f"p{i}") for i, p in enumerate(order)]
        best.append(F.max(F.when(valid, F.struct(*order_cols, F.col(column).alias("value")))).getField("value").alias(name))
    ends = [F.min(several).alias("_least"), F.max(several).alias("_most")] if several else []
    found = claims.where(F.col(group).isNotNull()).groupBy(group).agg(*best, *ends)
    return found.where("_least < _most").drop("_least", "_most") if several else found


def _dependence(judged: DataFrame, accuracy: DataFrame, false_values: int, copy_rate: float, prior_copy: float) -> DataFrame:
    """``field, s, s2, p``: the probability that source s copies a field from s2, from judged claims ``field, g, v, s, p``."""
    # pairs of sources only: at most the square of their number per value and per group
    one, two = judged.select("field", "g", "v", "s", "p"), judged.select("field", "g", "v", F.col("s").alias("s2"))
    pair = ["field", "s", "s2"]
    same = one.join(two, ["field", "g", "v"]).where("s <> s2").groupBy(*pair).agg(F.sum(1 - F.col("p")).alias("false_shared"), F.sum("p").alias("true_shared"), F.count_distinct("g").alias("n_same"))
    here = judged.select("field", "g", "s").distinct()
    met = here.join(here.withColumnRenamed("s", "s2"), ["field", "g"]).where("s <> s2").groupBy(*pair).agg(F.count(F.lit(1)).alias("n_met"))
    none = lambda x: F.coalesce(x, F.lit(0.0)).alias(x)
    shared = met.join(same, pair, "left").select(*pair, none("false_shared"), none("true_shared"), (F.col("n_met") - F.coalesce("n_same", F.lit(0))).alias("differ"))
    acc2 = accuracy.select("field", F.col("s").alias("s2"), F.col("a").alias("a2"))
    both_false, both_true = (1 - F.col("a")) * (1 - F.col("a2")) / false_values, F.col("a") * F.col("a2")
    differ = F.lit(1.0) - both_false - both_true
    # likelihood of what two sources share, true and false, and of where they differ: independent, or one copying at the rate
    said = lambda f, t, d: F.col("false_shared") * F.log(f) + F.col("true_shared") * F.log(t) + F.col("differ") * F.log(d)
    independent = said(both_false, both_true, differ)
    copying = said(copy_rate * (1 - F.col("a2")) + (1 - copy_rate) * both_false, copy_rate * F.col("a2") + (1 - copy_rate) * both_true, (1 - copy_rate) * differ)
    odds = copying - independent + F.lit(math.log(prior_copy / (1 - prior_copy)))
    return shared.join(accuracy, ["field", "s"]).join(acc2, ["field", "s2"]).select(*pair, (1 / (1 + F.exp(-F.least(F.greatest(odds, F.lit(-50.0)), F.lit(50.0))))).alias("p"))


def _posteriors(c: DataFrame, accuracy: DataFrame, depends: DataFrame, false_values: int, copy_rate: float) -> DataFrame:
    """``field, g, v, p``: the probability of each claimed value, from votes discounted for copying."""
    at, value = ["field", "g"], ["field", "g", "v"]
    scored = c.join(accuracy, ["field", "s"])
    vote = F.log(F.lit(float(false_values)) * F.col("a") / (1 - F.col("a")))
    # the chance that s took the value from one of the more accurate sources that give it
    other = scored.select(*value, F.col("s").alias("s2"), F.col("a").alias("a2"))
    above = (F.col("a2") > F.col("a")) | (F.col("a2") == F.col("a")) & (F.col("s2") < F.col("s"))
    copied = scored.join(other, value).where(above).join(depends, ["field", "s", "s2"]).groupBy(*value, "s").agg(F.sum(F.log(1 - F.lit(copy_rate) * F.col("p"))).alias("own"))
    scored = scored.join(copied, [*value, "s"], "left").withColumn("own", F.exp(F.coalesce("own", F.lit(0.0))))
    values = scored.groupBy(*value).agg(F.sum(vote * F.col("own")).alias("score"))
    tops = values.groupBy(*at).agg(F.max("score").alias("top"), F.count(F.lit(1)).alias("n"))
    weighed = values.join(tops, at).withColumn("w", F.exp(F.col("score") - F.col("top")))
    rest = F.greatest(F.lit(false_values + 1) - F.col("n"), F.lit(0)) * F.exp(-F.col("top"))
    totals = weighed.groupBy(*at, "top", "n").agg(F.sum("w").alias("total")).select(*at, (F.col("total") + rest).alias("z"))
    return weighed.join(totals, at).select(*value, (F.col("w") / F.col("z")).alias("p"))


SETTLED = 0.01  # change of every accuracy below which the estimates have settled


def fuse(claims: DataFrame, group: str, fields: list[str], source: str, settled: float = SETTLED, false_values: int = 20, copy_rate: float = 0.8, prior_copy: float = 0.1) -> DataFrame:
    """``group, field, value, posterior``: the most probable value of each group and field, by Bayesian fusion.

    ``claims`` has a column per field and a ``source``; null and meaningless values claim nothing, a
    null source is the source ''. A source that repeats a value for a group claims it once. Accuracies, one for each source
    and field, start at 0.8 and are re-estimated from the posteriors until none moves by ``settled``; each round goes half as far
    as the one before, so that sources judged to depend on each other in turn can't swing for ever. Two sources are judged dependent from how often they share a value that is probably false, against how often chance would
    have them do so. A source's vote is discounted by the probability that it copied it from a source of
    higher accuracy with the same value. Equal posteriors go to the smaller value. The number of sources is
    taken to be small (their pairs are a small table, joined by key and never collected); groups may be of any size, since
    claims are first counted per (group, value, source). Empty input gives no row.
    """
    value = F.explode(F.array(*[F.struct(F.lit(x).alias("field"), F.when(known(F.col(x).cast("string")), F.col(x).cast("string")).alias("v")) for x in fields])).alias("x")
    said = claims.where(F.col(group).isNotNull()).select(F.col(group).alias("g"), F.coalesce(F.col(source), F.lit("")).alias("s"), value)
    c = cut(said.select(F.col("x.field").alias("field"), "g", F.col("x.v").alias("v"), "s").where("v is not null").distinct())
    accuracy = cut(c.select("field", "s").distinct().withColumn("a", F.lit(0.8)))
    # before anything is known, what two sources share is presumed to be mostly true
    depends = cut(_dependence(c.withColumn("p", F.lit(PRESUMED)), accuracy, false_values, copy_rate, prior_copy))
    way = 1.0
    while True:
        posterior = cut(_posteriors(c, accuracy, depends, false_values, copy_rate))
        judged = c.join(posterior, ["field", "g", "v"])
        found = judged.groupBy("field", "s").agg(F.least(F.greatest(F.avg("p"), F.lit(0.05)), F.lit(0.99)).alias("now"))
        step = cut(accuracy.join(found, ["field", "s"]).select("field", "s", (F.col("a") + way * (F.col("now") - F.col("a"))).alias("a"), (way * F.abs(F.col("now") - F.col("a"))).alias("moved")))
        if not step.where(F.col("moved") >= settled).limit(1).count():
            break
        way /= 2
        accuracy = step.drop("moved")
        depends = cut(_dependence(judged, accuracy, false_values, copy_rate, prior_copy))
    best = posterior.groupBy("field", "g").agg(F.min(F.struct((-F.col("p")).alias("m"), F.col("v").alias("v"))).alias("b"))
    return best.select(F.col("g").alias(group), "field", F.col("b.v").alias("value"), (-F.col("b.m")).alias("posterior"))
