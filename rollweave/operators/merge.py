"""Merging candidates of several searches, ranking and top-k. Input order is always an explicit column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def merge_first(rows: DataFrame, keys: list[str], order: list[str], strategy: str, keep: list[str]) -> DataFrame:
    """One row per key: the first by ``order``, with ``via_strategies`` listing the strategies in order of appearance."""
    first = F.min(F.struct(*order, *[F.col(k).alias(f"_{k}") for k in keep]))
    seen = F.array_sort(F.collect_set(F.struct(F.col("_place"), F.col(strategy).alias("s"))))
    placed = rows.withColumn("_place", F.min(F.struct(*order)).over(Window.partitionBy(*keys, strategy)))
    merged = placed.groupBy(*keys).agg(first.alias("_first"), seen.alias("_seen"))
    return merged.select(*keys, *[F.col(f"_first._{k}").alias(k) for k in keep], F.transform("_seen", lambda x: x["s"]).alias("via_strategies"))


def merge_best(rows: DataFrame, keys: list[str], score: str, order: list[str], keep: list[str]) -> DataFrame:
    """One row per key: the highest score, the earliest of equals; null scores count as 0. A single aggregation."""
    best = F.min(F.struct((-F.coalesce(F.col(score), F.lit(0.0))).alias("_s"), *order, *[F.col(k).alias(f"_{k}") for k in keep]))
    return rows.groupBy(*keys).agg(best.alias("_b")).select(*keys, (-F.col("_b._s")).alias(score), *[F.col(f"_b._{k}").alias(k) for k in keep if k != score])


def top_per_key(rows: DataFrame, key: str, score: str, order: list[str], k: int = 20) -> DataFrame:
    """The ``k`` highest scores per key with ``rank`` from 1; equals stay in input order."""
    w = Window.partitionBy(key).orderBy(F.col(score).desc_nulls_last(), *order)
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def found_by(rows: DataFrame, strategy: str, params: str) -> DataFrame:
    """Rows with ``_found_by``, the strategy that found them and its parameters."""
    return rows.withColumn("_found_by", F.struct(F.col(strategy).alias("strategy"), F.col(params).alias("params")))


def compare_runs(old: DataFrame, new: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Full outer comparison of two runs: ``key, side`` (both, old, new) and the names of the values that differ."""
    a, b = old.select(key, *[F.col(v).alias(f"old_{v}") for v in values], F.lit(True).alias("_a")), new.select(key, *[F.col(v).alias(f"new_{v}") for v in values], F.lit(True).alias("_b"))
    j = a.join(b, key, "full_outer")
    side = F.when(F.col("_a") & F.col("_b"), "both").when(F.col("_a"), "old").otherwise("new")
    changed = F.array_compact(F.array(*[F.when(~F.col(f"old_{v}").eqNullSafe(F.col(f"new_{v}")), v) for v in values]))
    return j.select(key, side.alias("side"), F.when(side == "both", changed).otherwise(F.array().cast("array<string>")).alias("changed"))
