"""Reports over event logs, work items and decided records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollweave.operators.scoring import is_outlier, score_bucket


def status_histogram(rows: DataFrame, status: str, listed: list[str]) -> DataFrame:
    """One row with ``total`` and the number of rows of each listed status; others count in the total only."""
    return rows.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(status) == s).alias(s) for s in listed])


def outcome_summary(rows: DataFrame, status: str, score: str, floor: float = 0.40) -> DataFrame:
    """One row: total, done and outlier counts, and the share of outliers in per cent (0 for an empty table)."""
    out = is_outlier(status, score, floor)
    counted = rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(~out).alias("done"), F.count_if(out).alias("outliers"))
    return counted.withColumn("outlier_pct", F.round(F.when(F.col("total") == 0, 0.0).otherwise(100.0 * F.col("outliers") / F.col("total")), 1))


def run_report(rows: DataFrame, score: str, complete: list[str]) -> DataFrame:
    """``section, item, value``: score buckets and the completeness of fields in per cent, in one pass."""
    share = lambda c: F.round(100.0 * F.avg(F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) != "", 1.0).otherwise(0.0)), 2)
    one = rows.agg(*[share(c).alias(c) for c in complete])
    fields = one.select(F.explode(F.array(*[F.struct(F.lit("completeness").alias("section"), F.lit(c).alias("item"), F.col(c).alias("value")) for c in complete])).alias("x")).select("x.*")
    buckets = rows.groupBy(score_bucket(score).alias("item")).agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.lit("score").alias("section"), "item", "value")
    return fields.unionByName(buckets)


def strategy_stats(fetches: DataFrame, run: str, strategy: str, key: str, candidates: str, accepted_keys: DataFrame) -> DataFrame:
    """Per run and strategy: fires, candidates in sum and mean, records touched, records accepted and the rate of success."""
    joined = fetches.join(accepted_keys.select(key).distinct().withColumn("_ok", F.lit(True)), key, "left")
    per_key = joined.groupBy(run, strategy, key).agg(F.count(F.lit(1)).alias("fires"), F.sum(F.coalesce(F.col(candidates), F.lit(0))).alias("candidates"), F.max(F.coalesce("_ok", F.lit(False))).alias("ok"))
    stats = per_key.groupBy(run, strategy).agg(F.sum("fires").alias("fires"), F.sum("candidates").alias("candidates"), F.count(F.lit(1)).alias("touched"), F.count_if("ok").alias("accepted"))
    return stats.withColumns({"avg_candidates": F.col("candidates") / F.col("fires"), "success_rate": F.col("accepted") / F.col("touched")})


def across_runs(stats: DataFrame, strategy: str) -> DataFrame:
    """Counts summed over runs, and the plain mean of the runs' rates."""
    return stats.groupBy(strategy).agg(F.count(F.lit(1)).alias("runs"), F.sum("fires").alias("fires"), F.sum("candidates").alias("candidates"), F.sum("touched").alias("touched"), F.sum("accepted").alias("accepted"), F.avg("success_rate").alias("mean_success_rate"))


def nearest_rank(durations: DataFrame, by: str, value: str, q: float = 0.95) -> DataFrame:
    """``by`` and the element at place floor(q n) of its sorted values, the last one at most. Equal values are counted, never gathered."""
    counted = durations.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count(F.lit(1)).alias("_k"))
    totals = counted.groupBy(by).agg(F.sum("_k").alias("_n"))
    running = counted.withColumn("_end", F.sum("_k").over(Window.partitionBy(by).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)))
    place = F.least(F.floor(F.lit(q) * F.col("_n")), F.col("_n") - 1)
    return running.join(totals, by).where((F.col("_end") > place) & (F.col("_end") - F.col("_k") <= place)).select(by, F.col(value).alias("p95"))


def source_metrics(items: DataFrame, source: str, state: str, begun: Column, ended: Column) -> DataFrame:
    """Per knowledge source: items by outcome, success rate, mean and 95th percentile of the duration of completed items."""
    d = items.select(F.col(source), F.col(state).alias("_st"), (ended.cast("timestamp").cast("double") - begun.cast("timestamp").cast("double")).alias("_d"))
    done = F.col("_st").isin("succeeded", "terminal", "blocked")
    agg = d.groupBy(source).agg(F.count(F.lit(1)).alias("items"), F.count_if(F.col("_st") == "succeeded").alias("succeeded"), F.count_if(F.col("_st") == "retryable").alias("retryable"), F.count_if(done).alias("finished"), F.round(F.avg("_d"), 4).alias("avg_s"))
    agg = agg.withColumn("success_rate", F.round(F.when(F.col("finished") == 0, 0.0).otherwise(F.col("succeeded") / F.col("finished")), 6))
    return agg.join(nearest_rank(d, source, "_d"), source, "left").select(source, "items", "succeeded", "retryable", "success_rate", "avg_s", F.round("p95", 4).alias("p95_s"))


def paired_durations(events: DataFrame, key: str, at: str, kind: str, opens: str, closes: str) -> DataFrame:
    """``key, opened_at, closed_at, seconds``: each opening event with the closing event that follows it next."""
    w = Window.partitionBy(key).orderBy(at, kind)
    e = events.where(F.col(kind).isin(opens, closes)).select(key, at, kind, F.lead(at).over(w).alias("_next"), F.lead(kind).over(w).alias("_kind"))
    hit = e.where((F.col(kind) == opens) & (F.col("_kind") == closes))
    return hit.select(key, F.col(at).alias("opened_at"), F.col("_next").alias("closed_at"), (F.col("_next").cast("timestamp").cast("double") - F.col(at).cast("timestamp").cast("double")).alias("seconds"))


def histogram(rows: DataFrame, value: Column, name: str = "value") -> DataFrame:
    """``name, n``: rows per value."""
    return rows.groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def ambiguous_keys(rows: DataFrame, key: str, other: str) -> DataFrame:
    """Keys that stand with more than one value of another column."""
    return rows.groupBy(key).agg(F.count_distinct(other).alias("n")).where("n > 1")


def first_hit(rows: DataFrame, tiers: dict[str, Column]) -> DataFrame:
    """``tier, n, cumulative`` of predicates in order: how many rows each is the first to hit, and how many any up to it hits."""
    first = F.coalesce(*[F.when(c, F.lit(i)) for i, c in enumerate(tiers.values())])
    counts = rows.groupBy(first.alias("_i")).agg(F.count(F.lit(1)).alias("n")).where("_i is not null")
    names = rows.sparkSession.createDataFrame(list(enumerate(tiers)), "_i int, tier string")
    full = names.join(counts, "_i", "left").select("_i", "tier", F.coalesce("n", F.lit(0)).alias("n"))
    return full.select("tier", "n", F.sum("n").over(Window.orderBy("_i")).alias("cumulative"))  # one row per tier
