"""Deeply nested records to related flat tables, by shared inlining.

The schema graph is read from the data first: which element occurs under which, once or repeatedly,
and whether an element contains itself. Elements that repeat, that are shared by several parents or
that are recursive become tables of their own; what occurs once under one parent is inlined into the
parent's table as columns. Each flat row carries the key of its document, its path in it and the
path of its parent row, which is the foreign key.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROOT = "$"


@dataclass(frozen=True)
class Layout:
    """How documents are flattened.

    ``tables``: elements with a table of their own. ``inlined``: child element -> parent element.
    ``spelling``: alias -> field name. ``implied``: container elements that may be left out and then
    count as one, as (container, element below it). ``columns``: element -> inlined field -> its SQL type.
    """

    tables: frozenset[str]
    inlined: dict[str, str] = field(default_factory=dict)
    spelling: dict[str, str] = field(default_factory=dict)
    implied: tuple[tuple[str, str], ...] = ()
    columns: dict[str, dict[str, str]] = field(default_factory=dict)


def read_json(text: str | None) -> object:
    """The complete JSON value that ``text`` starts with, or None if there is none (damaged, cut off, null).

    A value that is itself JSON written as a string, however often, is decoded to the end.
    """
    value: object = text
    while isinstance(value, str):
        if not value:
            return None
        try:
            value = json.loads(value)
        except (ValueError, RecursionError):
            try:
                value = _DECODER.raw_decode(value.lstrip("﻿ \t\r\n"))[0]
            except (ValueError, RecursionError):
                return None
    return value


_DECODER = json.JSONDecoder()


#: What a field holds; objects and lists of objects are elements.
OBJECT, TEXT, WHOLE, REAL, TRUTH, LIST = "object", "text", "whole", "real", "truth", "list"


def _kind(value: object) -> str:
    if isinstance(value, dict) or isinstance(value, list) and any(isinstance(y, dict) for y in value):
        return OBJECT
    if isinstance(value, list):
        return LIST
    return TRUTH if isinstance(value, bool) else WHOLE if isinstance(value, int) else REAL if isinstance(value, float) else TEXT


def schema_graph(df: DataFrame, payload: str) -> DataFrame:
    """``parent, child, kind, repeated, n``: the fields of each element and what they hold, with how many values were seen.

    Objects and lists of objects are elements (kind ``object``). An edge is repeated if any value is a list.
    Damaged and null payloads, and null values, count for nothing. The result is as large as the schema, not the data.
    """

    def edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[tuple[str, str, str, bool], int] = {}
            for text in batch["payload"]:
                todo = [(ROOT, read_json(text))]
                while todo:
                    name, value = todo.pop()
                    for x in value if isinstance(value, list) else (value,):
                        if isinstance(x, dict):
                            for k, v in x.items():
                                if v is None:
                                    continue
                                edge = name, k, _kind(v), isinstance(v, list)
                                seen[edge] = seen.get(edge, 0) + 1
                                if edge[2] == OBJECT:
                                    todo.append((k, v))
            yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["parent", "child", "kind", "repeated", "n"])

    found = df.select(F.col(payload).alias("payload")).mapInPandas(edges, "parent string, child string, kind string, repeated boolean, n long")
    return found.groupBy("parent", "child", "kind").agg(F.max("repeated").alias("repeated"), F.sum("n").alias("n"))


SQL_TYPE = {frozenset((WHOLE,)): "bigint", frozenset((REAL,)): "double", frozenset((WHOLE, REAL)): "double", frozenset((TRUTH,)): "boolean"}


def plan_layout(graph: list[tuple[str, str, str, bool]], spelling: dict[str, str] | None = None, implied: tuple[tuple[str, str], ...] = ()) -> Layout:
    """Shared inlining over the edges of a schema graph: repeated, shared and recursive elements get tables.

    What is left is inlined into its parent's table, as typed columns: numbers and truth values where a field never
    holds anything else, text for all others.
    """
    spelling = dict(spelling or {})
    parents: dict[str, set[str]] = {}
    below: dict[str, set[str]] = {}
    fields: dict[tuple[str, str], set[str]] = {}
    for parent, child, kind, _ in graph:
        child = spelling.get(child, child)
        if kind == OBJECT:
            parents.setdefault(child, set()).add(parent)
            below.setdefault(parent, set()).add(child)
        else:
            fields.setdefault((parent, child), set()).add(kind)

    def reaches(start: str, goal: str) -> bool:
        todo, seen = [start], set()
        while todo:
            for x in below.get(todo.pop(), ()):
                if x == goal:
                    return True
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return False

    own = {child for _, child, kind, repeated in graph if kind == OBJECT and repeated} | {c for c, p in parents.items() if len(p) > 1 or reaches(c, c)} | {c for c, _ in implied}
    inlined = {c: next(iter(p)) for c, p in parents.items() if c not in own}
    columns: dict[str, dict[str, str]] = {}
    for (parent, name), kinds in fields.items():
        if name in parents:  # an empty list where others hold an element
            continue
        while parent in inlined:
            name, parent = f"{parent}.{name}", inlined[parent]
        columns.setdefault(parent, {})[name] = SQL_TYPE.get(frozenset(kinds), "string")
    return Layout(frozenset(own), inlined, spelling, tuple(implied), columns)


SHRED_SCHEMA = "parent_id string, element string, path string, parent_path string, child_id string, fields map<string,string>"


def shred(df: DataFrame, key: str, payload: str, layout: Layout, id_field: str, keep_fields: bool = True) -> DataFrame:
    """A row for each value of each element with a table: its element, path, parent's path, id and inlined fields.

    ``path`` counts places from 0, joined by ``/``; empty places of a list are counted, a single
    object is a list of one. A left-out implied container is place 0. Fields below an inlined element
    come as ``element.field``; an alias is stored under its field's name; lists of scalars as JSON.
    ``child_id`` is ``id_field`` as text, '' if absent. Damaged, null and empty payloads give no row;
    a null key is ''. Any depth is walked without recursion. Other columns of ``df`` are not read.
    """
    tables, spelling, implied = layout.tables, layout.spelling, dict((b, a) for a, b in layout.implied)

    def text(v: object) -> str:
        return v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for k, t in zip(batch["k"], batch["payload"]):
                document = read_json(t)
                todo: list[tuple[str, str, object]] = [("", ROOT, document)]  # path of the row, element, value
                while todo:
                    path, element, value = todo.pop()
                    if not isinstance(value, dict):
                        continue
                    fields: dict[str, str] = {}
                    inside = [("", value)]
                    while inside:
                        prefix, x = inside.pop()
                        for name, v in x.items():
                            name = spelling.get(name, name)
                            if name in tables:
                                base = path
                                if name in implied and element != implied[name]:
                                    base = f"{path}/0" if path else "0"
                                for i, y in enumerate(v if isinstance(v, list) else (v,)):
                                    if y is not None:
                                        todo.append((f"{base}/{i}" if base else str(i), name, y))
                            elif isinstance(v, dict):
                                inside.append((f"{prefix}{name}.", v))
                            elif v is not None and (keep_fields or not prefix and name == id_field):
                                fields[prefix + name] = text(v)
                    if element != ROOT:
                        out.append((k or "", element, path, path.rpartition("/")[0], fields.get(id_field, "").strip(), fields if keep_fields else {}))
            yield pd.DataFrame(out, columns=["parent_id", "element", "path", "parent_path", "child_id", "fields"])

    return df.select(F.col(key).cast("string").alias("k"), F.col(payload).alias("payload")).mapInPandas(rows, SHRED_SCHEMA)


LINKS = ("parent_id", "path", "parent_path")


def element_table(shredded: DataFrame, layout: Layout, element: str) -> DataFrame:
    """The table of one element: ``parent_id, path, parent_path`` and its inlined fields as typed columns.

    ``parent_id`` and ``parent_path`` are the foreign key of the row's parent. A field that was not there, or whose value
    isn't of its column's type, is null; dots of inlined fields become ``_``, and names that clash get one at their end.
    """
    taken = set(LINKS)
    columns = []
    for name, kind in sorted(layout.columns.get(element, {}).items()):
        alias = name.replace(".", "_")
        while alias in taken:
            alias += "_"
        taken.add(alias)
        columns.append(F.expr(f"try_cast(fields[{_quoted(name)}] AS {kind})").alias(alias))
    return shredded.where(F.col("element") == element).select(*LINKS, *columns)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def struct_tables(df: DataFrame, key: str, column: str) -> dict[str, DataFrame]:
    """The tables of a typed nested column, by shared inlining over its Spark type: ``column`` itself, and ``a.b`` for arrays below.

    Arrays of structs get a table each, with ``parent_id, path, parent_path`` and their fields; single structs are inlined
    as ``struct_field``. A single struct is a list of one. Null entries give no row but are counted places; null and empty
    arrays give none; a null key is ''. Nothing but the columns that are read is scanned.
    """
    tables: dict[str, DataFrame] = {}

    def inline(kind: T.StructType, at: Column, prefix: str, columns: list[Column], repeated: list[tuple[str, Column, T.DataType]], taken: set[str]) -> None:
        for f in kind.fields:
            value = at.getField(f.name)
            if isinstance(f.dataType, T.StructType):
                inline(f.dataType, value, f"{prefix}{f.name}_", columns, repeated, taken)
            elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
                repeated.append((f"{prefix}{f.name}", value, f.dataType.elementType))
            else:
                alias = prefix + f.name
                while alias in taken:
                    alias += "_"
                taken.add(alias)
                columns.append(value.alias(alias))

    def below(rows: DataFrame, element: str, kind: T.StructType) -> None:
        entries = rows.select("parent_id", F.col("path").alias("parent_path"), F.posexplode("value").alias("at", "entry")).where("entry is not null")
        path = F.when(F.col("parent_path") == "", F.col("at").cast("string")).otherwise(F.concat_ws("/", "parent_path", "at"))
        columns: list[Column] = []
        repeated: list[tuple[str, Column, T.DataType]] = []
        inline(kind, F.col("entry"), "", columns, repeated, set(LINKS))
        tables[element] = entries.select("parent_id", path.alias("path"), "parent_path", *columns)
        for name, value, inner in repeated:
            below(entries.select("parent_id", path.alias("path"), value.alias("value")), f"{element}.{name}", inner)

    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, T.StructType):
        kind, value = T.ArrayType(kind), F.array(value)
    below(df.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("parent_id"), F.lit("").alias("path"), value.alias("value")), column, kind.elementType)
    return tables
