"""The append-only log and the current state it implies: idempotent appends, replays, integrity, snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_id(log: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The log with the first row of each id only, whole rows kept; a single aggregation."""
    rest = [c for c in log.columns if c not in (key, *order)]
    return log.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in (*order, *rest)]).select(*log.columns)


def append_new(log: DataFrame, batch: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The rows of a batch whose id the log doesn't have yet, each id once."""
    return first_per_id(batch.join(log.select(key).distinct(), key, "left_anti"), key, order)


def last_per_key(rows: DataFrame, keys: list[str], at: str, tie: str, keep: list[str]) -> DataFrame:
    """The latest row of each key; of equal times the larger ``tie``."""
    return rows.groupBy(*keys).agg(F.max(F.struct(at, tie, *[F.col(k).alias(f"_{k}") for k in keep])).alias("_r")).select(*keys, F.col(f"_r.{at}").alias(at), *[F.col(f"_r._{k}").alias(k) for k in keep])


def since(log: DataFrame, at: str, seq: str, cursor_at: str | None, cursor_seq: str | None) -> DataFrame:
    """Rows after a cursor of (time, sequence), so that none of the same second is lost; all of them without a cursor."""
    if cursor_at is None:
        return log
    t = F.lit(cursor_at).cast("timestamp")
    return log.where((F.col(at) > t) | (F.col(at) == t) & (F.col(seq) > F.lit(cursor_seq)))


def resume(inputs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Inputs that have not been processed."""
    return inputs.join(done.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def backoff_seconds(attempt: Column, most: int = 60) -> Column:
    """Seconds to wait after a failed attempt: 2 to its power, at most ``most``."""
    return F.least(F.pow(F.lit(2.0), attempt), F.lit(float(most))).cast("int")


def state_after_failure(attempt: Column, most: int = 3) -> Column:
    """Retryable, or terminal after the last attempt."""
    return F.when(attempt >= most, "terminal").otherwise("retryable")


def claimable(items: DataFrame, state: str, not_before: str, lease: str, now: Column) -> DataFrame:
    """Items that can be claimed at a time: ready or retryable and not waiting, or leased with the lease run out."""
    due = F.col(state).isin("ready", "retryable") & F.coalesce(F.col(not_before) <= now, F.lit(True))
    return items.where(due | (F.col(state) == "leased") & F.coalesce(F.col(lease) < now, F.lit(False)))


def integrity_issues(rows: DataFrame, checks: dict[str, Column]) -> Column:
    """The names of the checks that a row fails."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), n) for n, c in checks.items()]))


def id_coverage(rows: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """``key, problem``: ids that are missing, repeated or not expected."""
    counted = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    j = counted.join(expected.select(key).distinct().withColumn("_e", F.lit(True)), key, "full_outer")
    problem = F.when(F.col("n").isNull(), "missing").when(F.col("_e").isNull(), "unexpected").when(F.col("n") > 1, "repeated")
    return j.select(key, problem.alias("problem")).where("problem is not null")


def update_by_key(rows: DataFrame, key: str, changes: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` with columns replaced from ``changes`` where its key occurs there."""
    side = changes.select(key, *[F.col(c).alias(f"_{c}") for c in columns], F.lit(True).alias("_hit")).dropDuplicates([key])
    j = rows.join(side, key, "left")
    return j.select(*[F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in rows.columns])


def digest(rows: DataFrame, key: str) -> DataFrame:
    """``rows, digest``: SHA-256 over the rows' own digests, whatever their order and partitions. Sums of digest words combine, so no row list is gathered."""
    names = sorted(rows.columns)
    h = F.sha2(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}), 256)
    words = [F.conv(F.substring(h, 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)") for i in range(4)]
    sums = rows.agg(F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(w), F.lit(0).cast("decimal(38,0)")).cast("string").alias(f"w{i}") for i, w in enumerate(words)])
    return sums.select("rows", F.sha2(F.concat_ws("|", F.col("rows").cast("string"), *[f"w{i}" for i in range(4)]), 256).alias("digest"))


def with_cooldowns(known: DataFrame, new: DataFrame) -> DataFrame:
    """``provider, not_before``: the known deadlines with the new ones in their place; of two new ones for a provider the later."""
    latest = new.groupBy("provider").agg(F.max("not_before").alias("not_before"))
    return known.select("provider", "not_before").join(latest, "provider", "left_anti").unionByName(latest)


def claimed(items: DataFrame, state: str, not_before: str, lease: str, now: Column, worker: str, seconds: int, order: list[str], n: int) -> DataFrame:
    """The first ``n`` items that can be claimed, leased to a worker: state, owner, deadline and the attempt counted up."""
    due = claimable(items, state, not_before, lease, now).orderBy(*order).limit(n)
    until = (now.cast("timestamp").cast("double") + seconds).cast("timestamp")
    return due.withColumns({state: F.lit("leased"), "leased_by": F.lit(worker), lease: until, "attempt": F.coalesce(F.col("attempt"), F.lit(0)) + 1})


def progress(rows: DataFrame, done: Column, total: int, begun: Column, now: Column) -> DataFrame:
    """One row: done, total, per cent, seconds so far and seconds left at the present rate (null before the first is done)."""
    c = rows.agg(F.count_if(done).alias("done"))
    took = now.cast("timestamp").cast("double") - begun.cast("timestamp").cast("double")
    left = F.when(F.col("done") > 0, took / F.col("done") * (F.lit(total) - F.col("done")))
    return c.select("done", F.lit(total).alias("total"), F.round(100.0 * F.col("done") / F.greatest(F.lit(total), F.lit(1)), 1).alias("percent"), took.alias("seconds"), left.alias("seconds_left"))


def batch(rows: DataFrame, order: list[str], prefix: tuple[str, str] | None = None, start: int = 0, end: int | None = None, seed: int | None = None) -> DataFrame:
    """A run's share of the input: rows whose column begins with a prefix, shuffled if seeded, from place ``start`` up to ``end``. The slice is the feature."""
    kept = rows if prefix is None else rows.where(F.col(prefix[0]).startswith(prefix[1]))
    ordered = kept.orderBy(F.xxhash64(F.lit(seed), *order), *order) if seed is not None else kept.orderBy(*order)
    skipped = ordered.offset(start) if start else ordered
    return skipped if end is None else skipped.limit(max(0, end - start))
