"""Sums and neighbours along one global order, without a task that holds all rows.

Rows are range-partitioned by the order; within a partition a window does, and what comes before or after it is known from
one row per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollweave.session import cut


def _ranged(df: DataFrame, order: list[Column]) -> DataFrame:
    return cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))


def running_sums(df: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """``df`` with, for each ``column: name``, the sum of the column over all rows up to this one in the order, equals included."""
    rows = _ranged(df, order)
    part = rows.groupBy("_part").agg(*[F.sum(c).alias(f"_s_{n}") for c, n in sums.items()])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = part.select("_part", *[F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums.values()])
    within = Window.partitionBy("_part").orderBy(*order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.select("*", *[F.sum(c).over(within).alias(f"_w_{n}") for c, n in sums.items()])
    return local.join(F.broadcast(offsets), "_part").select(*df.columns, *[(F.col(f"_w_{n}") + F.col(f"_o_{n}")).alias(n) for n in sums.values()])


def with_next(df: DataFrame, value: str, name: str) -> DataFrame:
    """``df`` with the next larger row's value of a column, null for the last. Values are distinct."""
    rows = _ranged(df, [F.col(value)])
    part = rows.groupBy("_part").agg(F.min(value).alias("_first"))
    after = part.select("_part", F.lead("_first").over(Window.orderBy("_part")).alias("_after"))  # one row per partition
    local = rows.withColumn("_next", F.lead(value).over(Window.partitionBy("_part").orderBy(value)))
    return local.join(F.broadcast(after), "_part").select(*df.columns, F.coalesce("_next", "_after").alias(name))
