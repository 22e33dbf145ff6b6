"""Registry of query builders ``(spark, sf_dir) -> DataFrame`` and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query under ``name``; ``oracle`` is its DuckDB SQL (None: rows-only check)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every query module so their decorators run."""
    from hebdo.plans import q_admin, q_calendar, q_gaps, q_layers, q_payload, q_stream, q_text, q_upsert  # noqa: F401
