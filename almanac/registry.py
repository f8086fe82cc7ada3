"""Registered queries: a name, a function of (spark, sf_dir), and the DuckDB SQL it must agree with."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

MODULES: tuple[str, ...] = ("series", "joins", "portfolios", "regimes", "replays", "contracts")


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


_FOUND: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register the decorated function of (spark, sf_dir)."""

    def keep(fn):
        _FOUND[name] = Query(fn, sql)
        return fn

    return keep


def load() -> dict[str, Query]:
    for m in MODULES:
        importlib.import_module(f"almanac.plans.{m}")
    return dict(_FOUND)
