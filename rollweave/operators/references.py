"""References to records that were not there when the reference was made.

Keys are dictionary-encoded as dense integers. Per range of 32,768 integers and per month, bits of
referenced keys and bits of keys whose record was there for the whole month are built by Spark's own
``bitmap_construct_agg``; reference AND-NOT parent leaves the suspects, whose bits are decoded. Only
the suspects are then held against the exact times, because a record may appear or vanish within the
month of the reference.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollweave.session import cut

RANGE_BITS = 15  # bitmap_construct_agg fills 4 KB: 32,768 keys
NEVER = 1 << 30


@dataclass(frozen=True)
class Reference:
    """A reference column: ``key`` is the normalised key (null or '' where blank), ``target`` the target's name."""

    table: str
    field: str
    rows: DataFrame
    row_id: Column
    key: Column
    made_at: Column
    target: str


@dataclass(frozen=True)
class Target:
    """Rows that keys lead to. Null ``start``: there from the beginning; null ``end``: there still."""

    name: str
    rows: DataFrame
    key: Column
    start: Column | None = None
    end: Column | None = None


def slug_key(text: Column) -> Column:
    """A prefixed id such as ``obs-00af``, whatever its case and the space around it; '' if blank."""
    return F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\s\p{Z}\p{C}]+", ""))


def number_key(text: Column) -> Column:
    """The memorial number in ``123``, ``000123``, ``#123``, ``FaG ID: 123`` or a ``/memorial/123/slug`` address; '' if none."""
    t = F.coalesce(text, F.lit(""))
    number = F.when(F.lower(t).contains("memorial/"), F.regexp_extract(F.lower(t), r"memorial/0*(\d+)", 1)).otherwise(F.regexp_extract(t, r"0*(\d+)", 1))
    return F.when(number != "", number).otherwise(F.lower(F.trim(t)))


def _month(at: Column) -> Column:
    return (F.year(at) * 12 + F.month(at) - 1).cast("int")


def _and_not(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """Suspects of one key range: referenced in a month, but not there for the whole of it."""
    group = group.sort_values(["month", "side"])  # 'a' appear, 'g' gone, 'r' referenced
    there, ids, months = np.zeros(4096, np.uint8), [], []
    for side, month, bits in zip(group["side"], group["month"], group["bits"]):
        words = np.frombuffer(bits, np.uint8)
        if side == "a":
            there = there | words
        elif side == "g":
            there = there & ~words
        else:
            left = np.flatnonzero(np.unpackbits(words & ~there, bitorder="little"))
            ids.append(left.astype("int64") + (int(key[0]) << RANGE_BITS))
            months.append(np.full(len(left), month, "int32"))
    if not ids:
        return pd.DataFrame({"key_id": pd.Series(dtype="int64"), "month": pd.Series(dtype="int32")})
    return pd.DataFrame({"key_id": np.concatenate(ids), "month": np.concatenate(months)})


def orphans(references: list[Reference], targets: list[Target]) -> DataFrame:
    """``ref_table, ref_field, row_id, period`` of each reference without a target row at its time.

    Blank keys are no references and give no row; repeated rows count once. A reference without a
    time is held against all times: it is an orphan only if its key exists nowhere, with period ''.
    A target row with a null key is ignored; a row removed before it was recorded was never there;
    a row removed at the very instant of the reference is gone. Empty tables give an empty result,
    or every reference where the target is empty. No other column of the inputs is read.
    """
    refs = reduce(
        DataFrame.unionByName,
        [r.rows.select(F.lit(r.table).alias("ref_table"), F.lit(r.field).alias("ref_field"), F.lit(r.target).alias("ns"), r.row_id.cast("long").alias("row_id"), r.key.alias("key"), r.made_at.cast("timestamp").alias("at")) for r in references],
    ).where("key <> ''")
    refs = refs.withColumn("month", F.coalesce(_month(F.col("at")), F.lit(NEVER)))
    there = reduce(
        DataFrame.unionByName,
        [
            t.rows.select(F.lit(t.name).alias("ns"), t.key.alias("key"), (F.lit(None) if t.start is None else t.start).cast("timestamp").alias("start"), (F.lit(None) if t.end is None else t.end).cast("timestamp").alias("end"), F.lit(t.start is not None).alias("dated"))
            for t in targets
        ],
    ).where("key <> ''")
    there = there.where(~F.coalesce(F.col("end") <= F.col("start"), F.lit(False)))

    # one row per key on either side; a hot key is pre-aggregated before the shuffle
    start = F.when(F.col("start").isNull(), F.when(F.col("dated"), NEVER).otherwise(-1)).otherwise(_month(F.col("start")))
    kept = there.groupBy("ns", "key").agg(
        F.min(F.when(F.col("end").isNull(), start)).alias("open_from"),
        F.min(F.when(F.col("end").isNotNull(), F.struct(start.alias("a"), _month(F.col("end")).alias("b")))).alias("closed"),
    )
    named = refs.groupBy("ns", "key").agg(F.collect_set("month").alias("months"))
    # known for whole months: a row that stays, from the month after it came; else the first that left, up to the month before
    coded = named.join(kept, ["ns", "key"], "left").select(
        "ns",
        "key",
        "months",
        F.coalesce(F.col("open_from"), F.when(F.col("closed.b") > F.col("closed.a") + 1, F.col("closed.a"))).alias("from"),
        F.when(F.col("open_from").isNull() & (F.col("closed.b") > F.col("closed.a") + 1), F.col("closed.b")).alias("until"),
        F.monotonically_increasing_id().alias("key_id"),
    )
    coded = cut(coded)

    place, bit = F.shiftright("key_id", RANGE_BITS).alias("range"), F.col("key_id").bitwiseAND((1 << RANGE_BITS) - 1)
    events = coded.select(
        place,
        bit.alias("bit"),
        F.explode(
            F.concat(
                F.transform("months", lambda m: F.struct(F.lit("r").alias("side"), m.alias("month"))),
                F.when(F.col("from").isNotNull(), F.array(F.struct(F.lit("a").alias("side"), F.when(F.col("from") < NEVER, F.col("from") + 1).otherwise(NEVER).cast("int").alias("month")))).otherwise(F.array()),
                F.when(F.col("until").isNotNull(), F.array(F.struct(F.lit("g").alias("side"), F.col("until").alias("month")))).otherwise(F.array()),
            )
        ).alias("e"),
    )
    bitmaps = events.groupBy("range", F.col("e.side").alias("side"), F.col("e.month").alias("month")).agg(F.bitmap_construct_agg("bit").alias("bits"))
    suspects = bitmaps.groupBy("range").applyInPandas(_and_not, "key_id long, month int").join(coded.select("key_id", "ns", "key"), "key_id").select("ns", "key", "month")

    held = refs.join(suspects, ["ns", "key", "month"]).distinct()
    at = F.coalesce(F.col("at"), F.lit("9999-01-01").cast("timestamp"))
    spans = there.join(suspects.select("ns", "key").distinct(), ["ns", "key"], "left_semi").groupBy("ns", "key", "end").agg(F.min(F.when(F.col("dated"), F.coalesce(F.col("start"), F.lit("9999-12-31").cast("timestamp"))).otherwise(F.lit("0001-01-01").cast("timestamp"))).alias("start"))
    a, b = held.alias("a"), spans.alias("b")
    met = (F.col("a.ns") == F.col("b.ns")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.at").isNull() | ((F.col("b.start") <= at) & (F.col("b.end").isNull() | (F.col("b.end") > at))))
    return a.join(b, met, "left_anti").select("ref_table", "ref_field", "row_id", F.coalesce(F.date_format("at", "yyyy-MM"), F.lit("")).alias("period")).distinct()


def orphan_report(found: DataFrame) -> DataFrame:
    """Orphans counted per table, field and period."""
    return found.groupBy("ref_table", "ref_field", "period").agg(F.count(F.lit(1)).alias("orphans"))


__all__: list[str] = ["Reference", "Target", "orphan_report", "orphans", "slug_key", "number_key"]
