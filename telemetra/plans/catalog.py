"""Registry of the named queries: id -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    build: Builder
    oracle: str | None
    doc: str = ""


REGISTRY: dict[str, Entry] = {}


def query(name: str, oracle: str | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query id {name}")
        REGISTRY[name] = Entry(name, fn, oracle, (fn.__doc__ or "").strip())
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    # importing the modules registers their queries
    from telemetra.plans import q_models, q_relational, q_quality, q_ingest, q_streaming, q_faults  # noqa: F401
    return REGISTRY
