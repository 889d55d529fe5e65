"""Consolidating pairwise matches into groups: connected components on a two-dimensional grid.

Vertices are hashed into B blocks, so edges fall into B x B cells; the edges of a hot vertex spread
over a whole row of cells. Each cell runs a local union-find and reports every vertex's smallest
local neighbour in its component (its representative). Representatives of one vertex from its row and
column are exchanged by a minimum, which is its parent; parents are followed to their roots, and where
representatives of a vertex have different roots an edge between these is left over. Those edges form
the next, much smaller grid, until none is left; the parents are then composed.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollweave.session import Scratch

CELL_EDGES = 200_000  # edges a cell is meant to hold: bounds the memory of one task
LAST_EDGES = 1_000  # edges between roots that are finished in one cell


def local_representatives(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """The smallest vertex of each vertex's component, for edges between 0..n-1, by hooking and pointer jumping."""
    parent = np.arange(n)
    while True:
        a, b = parent[u], parent[v]
        low, high = np.minimum(a, b), np.maximum(a, b)
        if not (low < high).any():
            return parent
        np.minimum.at(parent, high, low)
        while True:
            jumped = parent[parent]
            if (jumped == parent).all():
                break
            parent = jumped


def _cell(group: pd.DataFrame) -> pd.DataFrame:
    names, codes = np.unique(np.concatenate([group["u"].to_numpy(object), group["v"].to_numpy(object)]).astype(str), return_inverse=True)
    half = len(group)
    parent = local_representatives(codes[:half], codes[half:], len(names))
    return pd.DataFrame({"vertex": names, "rep": names[parent]})


def _exchange(edges: DataFrame, blocks: int) -> DataFrame:
    """``vertex, rep`` of each cell of the grid."""
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    return edges.select("u", "v", block("u").alias("row"), block("v").alias("column")).groupBy("row", "column").applyInPandas(_cell, "vertex string, rep string")


def _roots(scratch: Scratch, parents: DataFrame) -> DataFrame:
    """``vertex, root`` with every root followed to its end: each jump halves the way, so long chains take few. Drops ``parents``."""
    while True:
        up = parents.select(F.col("vertex").alias("root"), F.col("root").alias("up"))
        jumped = scratch.keep(parents.join(up, "root").select("vertex", F.col("up").alias("root"), (F.col("up") != F.col("root")).alias("moved")))
        scratch.drop(parents)
        if not jumped.where("moved").limit(1).count():
            return jumped
        parents = jumped


def connected_groups(edges: DataFrame, left: str, right: str, cell_edges: int = CELL_EDGES) -> DataFrame:
    """``ref, group_ref``: every vertex of an edge and the smallest vertex (string order) it is linked to.

    Null and empty ends, and edges from a vertex to itself, link nothing and give no row; repeated
    edges and either direction count once; an empty table gives none. Nothing but the number of edges
    left reaches the driver. Every vertex that is not the smallest around it is merged in each round, chains whole, so
    rounds grow with the logarithm of the largest group; the edges left over run between roots only. The grid has a cell
    for each core at least, 2 x 2 on one, and more where ``cell_edges`` asks for them.
    """
    cores = edges.sparkSession.sparkContext.defaultParallelism
    a, b = F.col(left).cast("string"), F.col(right).cast("string")
    scratch = Scratch(edges.sparkSession)
    now = scratch.keep(edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u is not null and v is not null and u <> '' and u <> v").distinct())
    parents: list[DataFrame] = []
    while n := now.count():
        blocks = 1 if n <= LAST_EDGES else max(2, math.ceil(math.sqrt(max(cores, n / cell_edges))))
        local = scratch.keep(_exchange(now, blocks))
        scratch.drop(now)
        if blocks == 1:
            parents.append(local.select(F.col("vertex").alias("ref"), F.col("rep").alias("group_ref")))
            break
        root = _roots(scratch, scratch.keep(local.groupBy("vertex").agg(F.min("rep").alias("root"))))
        parents.append(root.select(F.col("vertex").alias("ref"), F.col("root").alias("group_ref")))
        # what is left: links between the roots of a vertex and of its other representatives
        ends = local.where("rep <> vertex").join(root, "vertex").select("rep", F.col("root").alias("a")).distinct().join(root.select(F.col("vertex").alias("rep"), F.col("root").alias("b")), "rep")
        now = scratch.keep(ends.where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct())
        scratch.drop(local)
    if not parents:
        return now.select(F.col("u").alias("ref"), F.col("v").alias("group_ref"))
    found = parents[-1]
    for earlier in reversed(parents[:-1]):
        later = found.select(F.col("ref").alias("group_ref"), F.col("group_ref").alias("root"))
        found = earlier.join(later, "group_ref", "left").select("ref", F.coalesce("root", "group_ref").alias("group_ref"))
    return found


def accepted_pairs(pairs: DataFrame, left: Column, right: Column, verdict: Column, decided_at: Column, tie: Column, accepted: str = "match") -> DataFrame:
    """``u, v`` of the pairs whose latest verdict is ``accepted``, in either order of the two.

    Space and case of a reference do not matter. Of verdicts given at the same time the one with the
    larger ``tie`` holds; a null time counts as the earliest. Pairs with a null or blank end, or of a record with itself, give no row.
    """
    a, b = F.lower(F.trim(left)), F.lower(F.trim(right))
    kept = pairs.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"), a.isNull().alias("na"), b.isNull().alias("nb"), F.struct(F.coalesce(decided_at.cast("timestamp"), F.lit("0001-01-01").cast("timestamp")).alias("at"), tie.alias("tie"), F.lower(F.trim(verdict)).alias("verdict")).alias("said"))
    kept = kept.where("not na and not nb and u <> '' and v <> '' and u <> v")
    return kept.groupBy("u", "v").agg(F.max("said").alias("said")).where(F.col("said.verdict") == accepted).select("u", "v")
