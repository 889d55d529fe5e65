"""Readers of the input formats. Schemas are given, never inferred."""

from __future__ import annotations

import sqlite3
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


def json_array(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A file that holds one JSON array of records."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def json_lines(spark: SparkSession, path: str, schema: StructType | str, strict: bool = False) -> DataFrame:
    """One record per line; blank and damaged lines are skipped, or make the read fail if ``strict``."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def json_any(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A JSON array or JSON lines, told apart by the first character of the first file."""
    first = spark.read.text(path).where("trim(value) <> ''").limit(1).collect()
    return json_array(spark, path, schema) if first and first[0][0].lstrip("﻿ \t").startswith("[") else json_lines(spark, path, schema)


def csv_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Comma-separated values with a header; all text unless a schema is given."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def csv_after_preamble(spark: SparkSession, path: str, columns: list[str], header_start: str, file_pattern: str | None = None, file_fields: list[str] = ()) -> DataFrame:
    """Comma-separated files with a preamble of any length and a byte-order mark, and fields taken from their names.

    A row is data if it parses to as many fields as there are columns and comes after the header of its file; the preamble is
    told from data by the header line, which begins with ``header_start``.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    lines = lines.withColumn("value", F.regexp_replace("value", "^﻿", ""))
    heads = lines.where(F.startswith("value", F.lit(header_start))).groupBy("_file").agg(F.min("_at").alias("_head"))
    body = lines.join(F.broadcast(heads), "_file").where("_at > _head and trim(value) <> ''")
    parsed = body.select("_file", F.from_csv("value", ", ".join(f"`{c}` string" for c in columns)).alias("r")).select("_file", "r.*")
    named = [F.regexp_extract("_file", file_pattern, i).alias(f) for i, f in enumerate(file_fields, 1)] if file_pattern else []
    return parsed.select(*columns, *named)


def nested_groups(rows: DataFrame, key: str, header: list[str], order: str, member: list[str], name: str) -> DataFrame:
    """Flat rows as one record per key: header fields of the first row and all members as an array in order."""
    first = F.min(F.struct(order, *header)).alias("_h")
    items = F.array_sort(F.collect_list(F.struct(order, F.struct(*member).alias("_m")))).alias("_items")
    return rows.groupBy(key).agg(first, items).select(key, *[F.col(f"_h.{h}").alias(h) for h in header], F.transform("_items", lambda x: x["_m"]).alias(name))


def keyed_json(spark: SparkSession, path: str, field: str, value_schema: str) -> DataFrame:
    """``key, value`` of a JSON object that maps keys to records, below ``field``."""
    whole = spark.read.text(path, wholetext=True)
    parsed = whole.select(F.from_json("value", f"`{field}` map<string,{value_schema}>").alias("j"))
    return parsed.select(F.explode(F.col(f"j.{field}")).alias("key", "value"))


def page_cache(spark: SparkSession, path: str, days: int | None = None) -> DataFrame:
    """The last cached page of each memorial, from JSON lines; files older than ``days`` are left out."""
    lines = spark.read.schema("memorial_id string, slug string, html string, cached_at string").json(path).select("*", F.col("_metadata.file_modification_time").alias("_m"))
    if days is not None:
        lines = lines.where(F.col("_m") >= F.current_timestamp() - F.expr(f"interval {int(days)} days"))
    return lines.groupBy("memorial_id").agg(F.max(F.struct("cached_at", "slug", "html")).alias("r")).select("memorial_id", "r.slug", "r.html", "r.cached_at")


class _Span(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class SqliteReader(DataSourceReader):
    """Reads one query of a database file, or of a database inside a zip, in spans of its row numbers."""

    def __init__(self, options: dict, schema: StructType):
        self.path, self.table = options["path"], options["table"]
        self.member, self.columns = options.get("member"), [f.name for f in schema.fields]
        self.parts = int(options.get("partitions", "4"))

    def _open(self) -> sqlite3.Connection:
        path = self.path
        if self.member or path.endswith(".zip"):
            with zipfile.ZipFile(path) as z:
                name = self.member or next(n for n in z.namelist() if n.endswith((".db", ".sqlite")))
                path = z.extract(name, tempfile.mkdtemp())
        return sqlite3.connect(f"file:{path}?mode=ro", uri=True)

    def partitions(self) -> list[InputPartition]:
        with self._open() as db:
            low, high = db.execute(f'SELECT min(rowid), max(rowid) FROM "{self.table}"').fetchone()
        if low is None:
            return [_Span(0, -1)]
        step = max(1, -(-(high - low + 1) // self.parts))
        return [_Span(a, min(a + step - 1, high)) for a in range(low, high + 1, step)]

    def read(self, partition: _Span) -> Iterator[tuple]:
        names = ", ".join(f'"{c}"' for c in self.columns)
        with self._open() as db:
            yield from db.execute(f'SELECT {names} FROM "{self.table}" WHERE rowid BETWEEN ? AND ?', (partition.low, partition.high))


class SqliteSource(DataSource):
    """``spark.read.format("sqlite").option("table", t).schema(s).load(path)``; a path to a zip reads the database in it."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> str:
        raise ValueError("give a schema")

    def reader(self, schema: StructType) -> DataSourceReader:
        return SqliteReader(self.options, schema)


def first_readable(spark: SparkSession, schema: StructType | str, table: str, *paths: str | None) -> DataFrame:
    """The table of the first database or zip that exists; an empty table if none does."""
    spark.dataSource.register(SqliteSource)
    for p in paths:
        if p and Path(p).exists():
            return spark.read.format("sqlite").option("table", table).schema(schema).load(p)
    return spark.createDataFrame([], schema)
