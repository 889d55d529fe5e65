"""Learning from review labels: confusion, threshold sweep, calibration, pairwise weights. Each step is one aggregation."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollweave.operators.prefix import running_sums, with_next


def latest_labels(labels: DataFrame, key: str, at: str, keep: list[str]) -> DataFrame:
    """One label per key: the last by time, of equals the largest."""
    return labels.groupBy(key).agg(F.max(F.struct(at, *keep)).alias("_l")).select(key, *[F.col(f"_l.{k}").alias(k) for k in keep])


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, 0.0).otherwise(a / b)


def with_rates(c: DataFrame) -> DataFrame:
    """Confusion counts with precision, recall, F1 and accuracy, 0 where there is nothing to divide by."""
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    p, r = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return c.withColumns({"precision": p, "recall": r, "f1": _ratio(2 * p * r, p + r), "accuracy": _ratio(tp + tn, tp + fp + fn + tn)})


def confusion(pairs: DataFrame, truth: str, score: str, threshold: float) -> DataFrame:
    """One row: tp, fp, fn, tn of predicting scores from the threshold on, with the rates."""
    t, y = F.col(truth), F.col(score) >= threshold
    return with_rates(pairs.agg(F.count_if(t & y).alias("tp"), F.count_if(~t & y).alias("fp"), F.count_if(t & ~y).alias("fn"), F.count_if(~t & ~y).alias("tn")))


def threshold_sweep(pairs: DataFrame, truth: str, score: str) -> DataFrame:
    """``threshold`` and confusion for every candidate: 0, 1, all scores and the midpoints between neighbours.

    Scores are counted first; one running sum over the distinct scores replaces a pass per threshold.
    """
    d = pairs.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("s")).agg(F.count_if(F.col(truth)).alias("p"), F.count_if(~F.col(truth)).alias("n"))
    mids = with_next(d.select("s"), "s", "next").select((F.col("s") + (F.col("next") - F.col("s")) / 2).alias("threshold")).where("threshold is not null")
    ends = pairs.sparkSession.createDataFrame([(0.0,), (1.0,)], "threshold double")
    cuts = d.select(F.col("s").alias("threshold")).unionByName(mids).unionByName(ends).distinct()
    points = d.select(F.col("s").alias("x"), "p", "n", F.lit(None).cast("double").alias("threshold")).unionByName(cuts.select(F.col("threshold").alias("x"), F.lit(0).cast("long").alias("p"), F.lit(0).cast("long").alias("n"), "threshold"))
    # at a threshold, scores not below it are predicted
    sums = running_sums(points, [F.col("x").desc()], {"p": "tp", "n": "fp"}).where("threshold is not null").select("threshold", "tp", "fp")
    totals = d.agg(F.coalesce(F.sum("p"), F.lit(0)).alias("P"), F.coalesce(F.sum("n"), F.lit(0)).alias("N"))
    full = sums.crossJoin(F.broadcast(totals)).select("threshold", "tp", "fp", (F.col("P") - F.col("tp")).alias("fn"), (F.col("N") - F.col("fp")).alias("tn"))
    return with_rates(full)


def best_threshold(sweep: DataFrame, metric: str = "f1") -> DataFrame:
    """The row with the highest metric, the lowest threshold of equals."""
    return sweep.orderBy(F.col(metric).desc(), F.col("threshold")).limit(1)


def deciles(pairs: DataFrame, truth: str, score: str) -> DataFrame:
    """``bucket, avg_score, avg_accepted`` of tenths by score: bucket i holds the places from i n // 10 on."""
    d = pairs.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("s"), F.col(truth).cast("int").alias("y")).agg(F.count(F.lit(1)).alias("k"))
    ordered = running_sums(d, [F.col("s"), F.col("y")], {"k": "end"})
    total = d.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n"))
    tenths = ordered.crossJoin(F.broadcast(total)).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(9))))
    low, high = F.floor(F.col("i") * F.col("n") / 10), F.floor((F.col("i") + 1) * F.col("n") / 10)
    part = F.greatest(F.least(F.col("end"), high) - F.greatest(F.col("end") - F.col("k"), low), F.lit(0))
    w = tenths.select("i", "s", "y", part.alias("w")).where("w > 0")
    return w.groupBy(F.col("i").alias("bucket")).agg(F.round(F.sum(F.col("s") * F.col("w")) / F.sum("w"), 3).alias("avg_score"), F.round(F.sum(F.col("y") * F.col("w")) / F.sum("w"), 3).alias("avg_accepted"))


def linear_calibration(pairs: DataFrame, truth: str, score: str) -> DataFrame:
    """One row ``a, b``: b is the least-squares slope of acceptance on score, a the logit of the mean rate less b times the mean score; 0, 0 without spread."""
    y = F.col(truth).cast("double")
    s = pairs.agg(F.covar_pop(score, y).alias("c"), F.var_pop(score).alias("v"), F.avg(score).alias("x"), F.avg(y).alias("m"))
    flat = F.coalesce(F.col("v") < 0.0001, F.lit(True))
    b = F.when(flat, 0.0).otherwise(F.col("c") / F.col("v"))
    logit = F.log(F.greatest(F.col("m"), F.lit(0.01)) / F.greatest(1 - F.col("m"), F.lit(0.01)))
    return s.select(F.when(flat, 0.0).otherwise(logit - b * F.col("x")).alias("a"), b.alias("b"))


def probability(score: Column, a: Column | float, b: Column | float) -> Column:
    """Logistic of a + b score, held between -50 and 50."""
    z = (F.lit(a) if isinstance(a, float) else a) + (F.lit(b) if isinstance(b, float) else b) * F.coalesce(score, F.lit(0.0))
    return 1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-50.0)), F.lit(50.0))))


def score_for_probability(a: float, b: float, target: float = 0.95, steps: int = 20) -> float:
    """The score at which the calibrated probability reaches the target, by bisection, to three digits."""
    lo, hi = 0.0, 1.0
    for _ in range(steps):
        mid = (lo + hi) / 2
        if 1 / (1 + math.exp(-max(-50.0, min(50.0, a + b * mid)))) >= target:
            hi = mid
        else:
            lo = mid
    return round(hi, 3)


def pairwise_weights(deltas: DataFrame, features: list[str], defaults: dict[str, float], rate: float = 0.1, steps: int = 100, low: float = 0.1, high: float = 2.0, few: int = 100_000) -> dict[str, float]:
    """Feature weights by logistic regression on preference deltas, against a zero vector for each.

    Distinct deltas are counted first; up to ``few`` of them, which is checked, are read once and stepped over in the driver,
    else each step is one aggregation. No deltas give the defaults.
    """
    d = deltas.select(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features]).groupBy(*features).agg(F.count(F.lit(1)).alias("k")).cache()
    n, kinds = d.agg(F.sum("k"), F.count(F.lit(1))).first()
    if not n:
        return dict(defaults)
    w, bias = [0.0] * len(features), 0.0
    counted = np.array([tuple(r) for r in d.collect()], float) if kinds <= few else None

    def gradient() -> tuple[float, list[float]]:
        if counted is not None:
            x, k = counted[:, :-1], counted[:, -1]
            err = (1 - 1 / (1 + np.exp(-np.clip(bias + x @ np.array(w), -50, 50)))) * k
            return float(err.sum()), [float(g) for g in err @ x]
        z = F.lit(bias)
        for f, v in zip(features, w):
            z = z + F.col(f) * v
        err = (1 - 1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-50.0)), F.lit(50.0))))) * F.col("k")
        row = d.agg(F.sum(err).alias("e"), *[F.sum(err * F.col(f)).alias(f"g_{f}") for f in features]).first()
        return row["e"], [row[f"g_{f}"] for f in features]

    for _ in range(steps):
        e, g = gradient()
        p0 = 1 / (1 + math.exp(-bias))  # the zero vector's probability of being preferred
        w = [x + rate * y / (2 * n) for x, y in zip(w, g)]
        bias += rate * (e - p0 * n) / (2 * n)
    d.unpersist()
    raw = {f: min(max(defaults.get(f, 1.0) * (1 + x), low), high) for f, x in zip(features, w)}
    top = max(raw.values())
    return {f: v * high / top for f, v in raw.items()}


def strategy_utility(labels: DataFrame, strategy: str, decision: str, rank: str) -> DataFrame:
    """``strategy, total, accepted, top1, utility``: how often a strategy's candidate was accepted, and was the first of the ranking."""
    ok = F.col(decision) == "accepted"
    s = labels.where(F.coalesce(F.col(strategy), F.lit("")) != "").groupBy(strategy).agg(F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("accepted"), F.count_if(ok & (F.coalesce(F.col(rank), F.lit(1)) == 1)).alias("top1"))
    return s.withColumn("utility", F.round(F.col("accepted") / F.col("total") * (0.5 + 0.5 * F.col("top1") / F.greatest("accepted", F.lit(1))), 4))


def calibrated_decisions(decisions: DataFrame, score: str, model: DataFrame) -> DataFrame:
    """``decisions`` with ``calibrated_probability``, from a one-row ``model`` of ``a, b``; null without a model."""
    one = model.agg(F.first("a").alias("_a"), F.first("b").alias("_b"))
    return decisions.crossJoin(F.broadcast(one)).select(*decisions.columns, F.when(F.col("_a").isNotNull(), probability(F.col(score), F.col("_a"), F.col("_b"))).alias("calibrated_probability"))
