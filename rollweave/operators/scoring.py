"""Candidate scores, date windows and the decision policy, as column arithmetic inside code generation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollweave.functions import text as T
from rollweave.functions.phonetic import soundex
from rollweave.functions.text import ColumnLike

# fixed values: the windows in which birth and death years are plausible
BIRTHS, DEATHS = (1810, 1880), (1861, 1955)


def in_window(birth: ColumnLike, death: ColumnLike) -> Column:
    """Whether known years lie in the window; unknown ones pass."""
    b, d = T.year_anywhere(birth), T.year_anywhere(death)
    return F.coalesce(b.between(*BIRTHS), F.lit(True)) & F.coalesce(d.between(*DEATHS), F.lit(True))


@dataclass(frozen=True)
class Weights:
    last: float = 0.22
    first: float = 0.17
    middle: float = 0.11
    home: float = 0.10
    state: float = 0.05
    veteran: float = 0.18
    death: float = 0.22


def with_features(df: DataFrame, name: str, local: dict[str, ColumnLike], found: dict[str, ColumnLike], home: str = "OK") -> DataFrame:
    """``df`` with a struct of candidate features: last, first, middle, home, state, veteran, death, all 0 outside the window.

    ``local``: first, middle, last, state, death; ``found``: slug, state, veteran, birth, death. Shared parts are projected once,
    which keeps the expression small enough for generated code.
    """
    c = F.col
    d = df.withColumn("_slug", T.slug_parts(found["slug"]))
    d = d.withColumns(
        {
            "_ll": T.normalise(local["last"]), "_sl": T.normalise("_slug.last"), "_lf": T.normalise(local["first"]), "_sf": T.normalise("_slug.first"), "_lm": T.normalise(local["middle"]), "_sm": T.normalise("_slug.middle"),
            "_theirs": F.upper(T.text(found["state"])), "_ours": F.upper(T.text(local["state"])), "_inside": in_window(found["birth"], found["death"]),
            "_gap": F.abs(F.trim(T.text(local["death"])).try_cast("int") - F.trim(T.text(found["death"])).try_cast("int")), "_vet": F.coalesce(T._c(found["veteran"]), F.lit(False)),
        }
    )
    d = d.withColumns({"_same_last": (c("_sl") != "") & (soundex("_ll") == soundex("_sl")), "_same_first": (c("_sf") != "") & (soundex("_lf") == soundex("_sf"))})
    part = (c("_ll") != "") & (c("_sl") != "") & (F.startswith("_ll", "_sl") | F.startswith("_sl", "_ll"))
    initial = (c("_lf") != "") & (c("_sf") != "") & (F.substring("_lf", 1, 1) == F.substring("_sf", 1, 1))
    values = {
        "last": F.when(c("_ll") == c("_sl"), 1.0).when(part, 0.7).when(c("_same_last"), 0.5).otherwise(0.0),
        "first": F.when(c("_lf") == c("_sf"), 1.0).when(initial, 0.6).when(c("_same_first"), 0.4).otherwise(0.0),
        "middle": F.when(c("_lm") == "", 0.5).when(c("_sm") == "", 0.0).when(c("_lm") == c("_sm"), 1.0).when(F.substring("_lm", 1, 1) == F.substring("_sm", 1, 1), 0.5).otherwise(0.0),
        "home": F.when(c("_theirs") == home, 0.3).otherwise(0.0),
        "state": F.when((c("_ours") != "") & (c("_ours") == c("_theirs")), 0.1).otherwise(0.0),
        "veteran": F.when(c("_vet"), 0.8).otherwise(0.0),
        "death": F.when(c("_gap") == 0, 0.5).when(c("_gap") <= 2, 0.4).when(c("_gap") <= 5, 0.2).otherwise(0.0),
    }
    out = d.withColumn(name, F.struct(*[F.when(c("_inside"), v).otherwise(0.0).alias(k) for k, v in values.items()]))
    return out.drop("_slug", "_ll", "_sl", "_lf", "_sf", "_lm", "_sm", "_theirs", "_ours", "_inside", "_gap", "_vet", "_same_last", "_same_first")


def weighted_score(features: ColumnLike, weights: Weights = Weights()) -> Column:
    """The weighted sum of candidate features, in the order of the weights."""
    f = T._c(features)
    total = F.lit(weights.last) * f["last"] + weights.first * f["first"] + weights.middle * f["middle"]
    return total + weights.home * f["home"] + weights.state * f["state"] + weights.veteran * f["veteran"] + weights.death * f["death"]


def notice_score(first: ColumnLike, last: ColumnLike, state: ColumnLike, birth: ColumnLike, death: ColumnLike, title: ColumnLike, place: ColumnLike, date: ColumnLike) -> Column:
    """Score of a newspaper notice: names in its title, state in its place, and its year in the person's span."""
    has = lambda needle, hay: (T.text(needle) != "") & F.contains(F.lower(T.text(hay)), F.lower(T.text(needle)))
    whole = lambda x: F.when(T.text(x).rlike(r"^\d+$"), T.text(x).try_cast("int"))
    y, b, d = F.substring(T.text(date), 1, 4).try_cast("int"), whole(birth), whole(death)
    inside = F.when(b.isNotNull() & d.isNotNull(), y.between(b - 5, d + 5)).when(b.isNotNull(), y.between(b - 5, b + 30)).when(d.isNotNull(), y.between(d - 30, d + 5))
    points = lambda c, w: F.when(F.coalesce(c, F.lit(False)), w).otherwise(0.0)
    return F.least(points(has(last, title), 0.4) + points(has(first, title), 0.2) + points(has(state, place), 0.2) + points(inside, 0.2), F.lit(1.0))


@dataclass(frozen=True)
class Policy:
    """Thresholds of the decision: with and without a known death year, the gap to the second, and the floor."""

    accept: float = 0.70
    accept_no_death: float = 0.60
    gap: float = 0.10
    floor: float = 0.40
    version: str = "1"


def decision(n: ColumnLike, top: ColumnLike, second: ColumnLike, death: ColumnLike, warned: Column | None = None, policy: Policy = Policy()) -> Column:
    """``status, gap, threshold`` from the number of candidates and the two best scores."""
    n, top, second = T._c(n), F.coalesce(T._c(top), F.lit(0.0)), F.coalesce(T._c(second), F.lit(0.0))
    known = ~T.text(death).isin("", "0")
    threshold = F.when(known, policy.accept).otherwise(policy.accept_no_death)
    gap = top - second
    clear = (top >= threshold) & ((n == 1) | (gap >= policy.gap))
    status = F.when(n == 0, "no_candidates").when(top < policy.floor, "low_score").when(F.lit(False) if warned is None else warned, "needs_review").when(clear, "auto_accept").otherwise("needs_review")
    return F.struct(status.alias("status"), F.when(n > 0, gap).otherwise(0.0).alias("gap"), threshold.alias("threshold"))


def decide(scored: DataFrame, key: str, score: str, death: str, policy: Policy = Policy()) -> DataFrame:
    """One decision per key from its scored candidates (null scores are no candidates). Scores are counted before they are shuffled, and no key's candidates are gathered."""
    counts = scored.groupBy(key, F.col(score).alias("_s")).agg(F.count(score).alias("_k"), F.max(death).alias("_d"))
    mine = Window.partitionBy(key)
    ranked = counts.withColumns({"_n": F.row_number().over(mine.orderBy(F.col("_s").desc_nulls_last())), "_all": F.sum("_k").over(mine), "_death": F.max("_d").over(mine)})
    place = lambda i, c: F.max(F.when(F.col("_n") == i, F.col(c)))
    two = ranked.where("_n <= 2").groupBy(key).agg(F.max("_all").alias("candidates"), place(1, "_s").alias("_a"), place(1, "_k").alias("_ak"), place(2, "_s").alias("_b"), F.max("_death").alias("_d"))
    second = F.when(F.col("_ak") > 1, F.col("_a")).otherwise(F.col("_b"))
    d = two.select(key, "candidates", F.coalesce("_a", F.lit(0.0)).alias("top_score"), F.coalesce(second, F.lit(0.0)).alias("second_score"), "_d")
    return d.withColumn("d", decision("candidates", "top_score", "second_score", "_d", policy=policy)).select(key, "candidates", "top_score", "second_score", "d.status", "d.gap", "d.threshold")


def status_of_score(score: ColumnLike, status: ColumnLike | None = None, floor: float = 0.40, accept: float = 0.85) -> Column:
    """The status already given, else the one of the score."""
    s = T._c(score)
    derived = F.when(s >= accept, "auto_accept").when(s >= floor, "needs_review").otherwise("low_score")
    return derived if status is None else F.when(T.text(status) != "", T.text(status)).otherwise(derived)


def is_outlier(status: ColumnLike, score: ColumnLike, floor: float = 0.40) -> Column:
    """Whether a record failed to be searched or its best score is below the floor."""
    return T.text(status).isin("no_results", "error", "captcha", "not_run") | (F.coalesce(T._c(score), F.lit(0.0)) < floor)


SCORE_EDGES = (0.20, 0.40, 0.60, 0.80, 0.95)


def score_bucket(score: ColumnLike) -> Column:
    """The bucket of a score: below .20, then up to .40, .60, .80, .95, and above."""
    s, names = F.coalesce(T._c(score), F.lit(0.0)), ["<0.20", "0.20-0.40", "0.40-0.60", "0.60-0.80", "0.80-0.95", ">=0.95"]
    out = F.when(s < SCORE_EDGES[0], names[0])
    for edge, name in zip(SCORE_EDGES[1:], names[1:]):
        out = out.when(s < edge, name)
    return out.otherwise(names[-1])
