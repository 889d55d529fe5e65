"""Writers: atomic replacement, exports, snapshots with rollback, schema and provenance sidecars."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append_lines(df: DataFrame, path: str) -> None:
    """Rows appended as JSON lines; each write is committed as a whole."""
    df.write.mode("append").json(path)


def _storage(spark: SparkSession, path: str) -> tuple:
    """The file system that holds ``path``, shared or local, and how to name places on it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return place(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def replace_table(df: DataFrame, path: str) -> None:
    """A Parquet table replaced by a new one, also if it is read from itself.

    The new one is written whole beside it first, on the same storage, and then takes its name in two renames; if the second
    fails, the old table gets its name back. What is left of the old one is removed at the end.
    """
    storage, place = _storage(df.sparkSession, path)
    mark = uuid.uuid4().hex
    target, fresh, old = place(path), place(f"{path}.{mark}"), place(f"{path}.{mark}.old")
    df.write.parquet(f"{path}.{mark}")
    there = storage.exists(target)
    if there and not storage.rename(target, old):
        raise OSError(f"{path} can't be moved aside")
    if not storage.rename(fresh, target):
        if there:
            storage.rename(old, target)
        raise OSError(f"the new table can't take the place of {path}")
    if there:
        storage.delete(old, True)


def write_json_and_csv(df: DataFrame, folder: str, name: str, key: str) -> None:
    """The same rows in order of their key as JSON lines and as CSV (nested fields as JSON text)."""
    ordered = df.orderBy(key)
    ordered.write.mode("overwrite").json(f"{folder}/{name}.json")
    flat = [F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes]
    ordered.select(*flat).write.mode("overwrite").option("header", True).csv(f"{folder}/{name}.csv")


def write_text(df: DataFrame, column: str, path: str) -> None:
    """One line of text per row, for records that are JSON already."""
    df.select(column).write.mode("overwrite").text(path)


def write_schema(df: DataFrame, path: str, descriptions: dict[str, str] | None = None, version: int = 2) -> None:
    """A sidecar with the schema, its version and what the fields mean."""
    fields = [{"name": f.name, "type": f.dataType.simpleString(), "nullable": f.nullable, "description": (descriptions or {}).get(f.name, "")} for f in df.schema.fields]
    Path(path).write_text(json.dumps({"schema_version": version, "fields": fields}, indent=2), encoding="utf-8")


def write_provenance(path: str, source: str, collection: str, records: int) -> None:
    """A sidecar that says where records came from, when and how many."""
    Path(path).write_text(json.dumps({"source": source, "collection": collection, "pulled_at": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()), "record_count": records}, indent=2), encoding="utf-8")


class Snapshots:
    """Labelled copies of a table with their row count and digest, listed by time, and rollback to one."""

    def __init__(self, spark: SparkSession, table: str, folder: str):
        self.spark, self.table, self.folder = spark, table, Path(folder)

    def take(self, label: str | None = None) -> str:
        label = label or time.strftime("%Y%m%dT%H%M%S", time.gmtime()) + f"-{uuid.uuid4().hex[:6]}"
        place = self.folder / label
        self.spark.read.parquet(self.table).write.mode("overwrite").parquet(str(place / "data"))
        rows = self.spark.read.parquet(str(place / "data"))
        names = sorted(rows.columns)
        total = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64(*names).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("h")).first()
        meta = {"label": label, "taken_at": time.time(), "records": total["n"], "digest": hashlib.sha256(total["h"].encode()).hexdigest()}
        (place / "meta.json").write_text(json.dumps(meta), encoding="utf-8")
        return label

    def list(self) -> list[dict]:
        return sorted((json.loads(p.read_text()) for p in self.folder.glob("*/meta.json")), key=lambda m: m["taken_at"])

    def rollback(self, label: str = "latest") -> str:
        known = self.list()
        if not known:
            raise FileNotFoundError("no snapshot")
        chosen = known[-1] if label == "latest" else next((m for m in known if m["label"] == label), None)
        if chosen is None:
            raise FileNotFoundError(label)
        replace_table(self.spark.read.parquet(str(self.folder / chosen["label"] / "data")), self.table)
        return chosen["label"]
