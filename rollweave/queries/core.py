"""Queries of the core operators, by name, each with its SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rollweave.queries import crossref, matching, names, planning, records, reports

MODULES = (records, names, matching, planning, reports, crossref)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for m in MODULES for k, v in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.oracle_sql().items()}
