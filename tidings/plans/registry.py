"""Query registry: name -> Spark plan builder ``(spark, sf_dir) -> DataFrame`` and optional oracle SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_MODULES = [
    "tidings.plans.items",
    "tidings.plans.text",
    "tidings.plans.vectors",
    "tidings.plans.textvec",
    "tidings.plans.facts",
    "tidings.plans.briefing",
    "tidings.plans.outputs",
    "tidings.plans.chain",
    "tidings.plans.streams",
]


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def load_all() -> None:
    for m in _MODULES:
        importlib.import_module(m)
