"""Connected components of an edge table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollweave.session import cut


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``id, component``: every vertex of an edge with the smallest id of its component.

    Each round, a vertex takes the smallest label around it and then its label's label, so rounds grow with the logarithm
    of the longest chain. Null ends and loops link nothing. Ends when no label moves; lineage is cut every round on shared storage.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
    both = cut(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = cut(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("id"), F.least("u", "m").alias("component")))
    while True:
        near = both.join(labels.select(F.col("id").alias("v"), F.col("component").alias("c")), "v").groupBy("u").agg(F.min("c").alias("c"))
        step = labels.join(near.withColumnRenamed("u", "id"), "id", "left").select("id", F.col("component").alias("old"), F.least("component", F.coalesce("c", "component")).alias("new"))
        jump = step.join(step.select(F.col("id").alias("new"), F.col("new").alias("far")), "new", "left").select("id", "old", F.least("new", F.coalesce("far", "new")).alias("component"))
        jump = cut(jump)
        labels = jump.select("id", "component")
        if not jump.where("component <> old").limit(1).count():
            break
    return labels
