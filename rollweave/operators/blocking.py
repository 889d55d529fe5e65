"""Candidate pruning by block keys: an equi-join on exploded keys instead of all pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollweave.functions.phonetic import metaphone, nysiis
from rollweave.functions.text import ColumnLike, split_name, text


def with_codes(df: DataFrame, names: dict[str, ColumnLike]) -> DataFrame:
    """``df`` with ``<name>_metaphone`` and ``<name>_nysiis`` of each name column; every distinct name is coded once."""
    for label, column in names.items():
        df = df.withColumn(f"_{label}", F.lower(text(column)))
        coded = df.select(f"_{label}").distinct().withColumns({f"{label}_metaphone": metaphone(f"_{label}"), f"{label}_nysiis": nysiis(f"_{label}")})
        df = df.join(coded, f"_{label}", "left").drop(f"_{label}")
    return df


def block_keys(first: str = "first", last: str = "last") -> Column:
    """The keys of a coded row: surname by sound (two codes) and by two letters, first name by sound."""
    key = lambda tag, c: F.when(c != "", F.concat(F.lit(f"{tag}:"), c))
    return F.array_compact(
        F.array(
            key("surname_metaphone", F.col(f"{last}_metaphone")),
            key("surname_nysiis", F.col(f"{last}_nysiis")),
            key("surname_prefix", F.lower(F.substring(text(last), 1, 2))),
            key("firstname_metaphone", F.col(f"{first}_metaphone")),
        )
    )


def block_index(registry: DataFrame, key: str, name: ColumnLike) -> DataFrame:
    """``block_key, key``: the inverted index over whole names; a lone word is a first name. Rows without an id give none."""
    parts = registry.where(F.col(key).isNotNull()).select(F.col(key), split_name(name, "first").alias("n")).select(key, F.col("n.first").alias("first"), F.col("n.last").alias("last"))
    return with_codes(parts, {"first": "first", "last": "last"}).select(F.explode(block_keys()).alias("block_key"), key).distinct()


def block_lookup(queries: DataFrame, query_key: str, first: ColumnLike, last: ColumnLike, index: DataFrame, key: str, most: int | None = None) -> DataFrame:
    """``query_key, key``: the distinct registry ids that share a block with each query, at most the ``most`` smallest ids.

    Queries without any name meet nothing. Hot keys are left to adaptive skew handling; nothing is broadcast unless Spark
    finds it small.
    """
    asked = queries.select(F.col(query_key), text(first).alias("first"), text(last).alias("last"))
    keyed = with_codes(asked, {"first": "first", "last": "last"}).select(query_key, F.explode(block_keys()).alias("block_key"))
    if most is not None:  # no more than the smallest of a block can be among the smallest of all
        place = F.row_number().over(Window.partitionBy("block_key").orderBy(key))
        index = index.distinct().withColumn("_n", place).where(F.col("_n") <= most).drop("_n")
    pairs = keyed.join(index, "block_key").select(query_key, key).distinct()
    if most is None:
        return pairs
    ranked = pairs.withColumn("_n", F.row_number().over(Window.partitionBy(query_key).orderBy(key)))
    return ranked.where(F.col("_n") <= most).drop("_n")
