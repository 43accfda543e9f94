"""Registry of named queries and their SQL counterparts."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
MODULES = ("quality", "preparation", "diagnostics", "screening", "evaluation", "sparsity", "models", "clustering")


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        key = name or fn.__name__
        if key in REGISTRY:
            raise ValueError(f"query {key} is registered twice")
        REGISTRY[key] = Entry(fn, sql)
        return fn

    return add


def load_all() -> dict[str, Entry]:
    for module in MODULES:
        importlib.import_module(f"quillstat.catalog.{module}")
    return REGISTRY
