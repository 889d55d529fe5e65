"""The log as a stream: idempotent ingest, windows over events, and the work-item state machine."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType


def read_log(spark: SparkSession, folder: str, schema: StructType | str, files_per_trigger: int | None = None) -> DataFrame:
    """A folder of Parquet files as a stream."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(folder)


def once_per_id(stream: DataFrame, key: str, at: str, delay: str = "10 days") -> DataFrame:
    """The stream without re-deliveries of an id within the watermark; state is dropped beyond it."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, at: str, by: list[str], value: str, size: str, slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Rows and sum of a value per tumbling, or with ``slide`` sliding, window; late rows within the watermark count."""
    w = F.window(at, size, slide) if slide else F.window(at, size)
    return stream.withWatermark(at, delay).groupBy(w.alias("_w"), *by).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), *by, "n", "total")


def sessions(stream: DataFrame, at: str, key: str, gap: str, delay: str = "1 hour") -> DataFrame:
    """Sessions of a key: runs of rows with less than ``gap`` between them."""
    return stream.withWatermark(at, delay).groupBy(F.session_window(at, gap).alias("_w"), key).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), "n")


# fixed values: event -> state; a state of this list takes no more events
WORK_STATES = {"enqueued": "ready", "claimed": "leased", "succeeded": "succeeded", "failed": "retryable", "blocked": "blocked"}
FINAL_STATES = ("succeeded", "blocked", "terminal")
MOST_ATTEMPTS = 3


def work_state_machine(stream: DataFrame, key: str, event: str, at: str) -> DataFrame:
    """``work_id, state, attempt, changed_at`` after each batch of transition events of an item, in order of their time.

    A claim counts an attempt, a failure of the last attempt is terminal, and final states take no more events.
    """

    def step(item: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:  # noqa: ANN001
        now, attempt, seen = state.get if state.exists else ("ready", 0, 0)
        rows = pd.concat(list(batches)).sort_values(["at", "event"], kind="stable")
        for e, t in zip(rows["event"], rows["at"]):
            if now in FINAL_STATES:
                break
            attempt += e == "claimed"
            now = "terminal" if e == "failed" and attempt >= MOST_ATTEMPTS else WORK_STATES.get(e, now)
            seen = max(seen, int(pd.Timestamp(t).value // 1000))
        state.update((now, attempt, seen))
        yield pd.DataFrame({"work_id": [item[0]], "state": [now], "attempt": [attempt], "changed_at": [pd.Timestamp(seen, unit="us")]})

    events = stream.select(F.col(key).alias("work_id"), F.col(event).alias("event"), F.col(at).cast("timestamp_ntz").alias("at"))
    return events.groupBy("work_id").applyInPandasWithState(step, "work_id string, state string, attempt int, changed_at timestamp", "state string, attempt int, seen long", "update", "NoTimeout")


def work_states_batch(events: DataFrame, key: str, event: str, at: str) -> DataFrame:
    """The same from a table: the state of each item after its last event, without gathering its events.

    The first final event in time decides; before one, the latest event does, and failures count claims.
    """
    e = events.select(F.col(key).alias("work_id"), F.col(event).alias("event"), F.col(at).alias("at"))
    final: Column = F.col("event").isin("succeeded", "blocked")
    agg = e.groupBy("work_id").agg(F.max(F.struct("at", "event")).alias("last"), F.min(F.when(final, F.struct("at", "event"))).alias("end"), F.count_if(F.col("event") == "claimed").alias("attempt"))
    state = F.create_map(*[x for k, v in WORK_STATES.items() for x in (F.lit(k), F.lit(v))])
    known = F.try_element_at(state, F.coalesce(F.col("end.event"), F.col("last.event")))
    out = F.when((F.col("last.event") == "failed") & F.col("end").isNull() & (F.col("attempt") >= MOST_ATTEMPTS), "terminal").otherwise(known)
    return agg.select("work_id", out.alias("state"), F.col("attempt").cast("int").alias("attempt"))


def run_to_memory(stream: DataFrame, name: str, mode: str = "append") -> StreamingQuery:
    """Runs a stream over what is there into a table in memory, then stops: for tests and small reports."""
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
