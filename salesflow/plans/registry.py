"""Query registry: name -> (Spark builder, DuckDB oracle SQL, inventory ids)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, ids: tuple[str, ...] = ()):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` with its oracle SQL."""

    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        REGISTRY[name] = Query(name, fn, sql, tuple(ids))
        return fn

    return deco


def load_all() -> dict[str, Query]:
    # importing the plan modules fills REGISTRY
    from salesflow.plans import (  # noqa: F401
        drift_q, features_q, io_q, missing_q, models_q, monitor_q, preprocess_q, quality_q,
        relational_q, selection_q, streaming_q, summary_q, windows_q,
    )
    return REGISTRY
