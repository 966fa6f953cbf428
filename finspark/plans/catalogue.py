"""Registry of catalogue queries: name -> (spark builder, DuckDB oracle SQL).

Every builder takes (spark, sf_dir) and reads the whole test tables (or views
Spark derives from them).  The oracle SQL runs on DuckDB over the same
parquet files, registered as views under the table names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None = None):
    """Register a catalogue query; ``sql=None`` means rows-only check."""
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = (fn, sql)
        return fn
    return deco


def load_all() -> dict[str, tuple[Builder, str | None]]:
    # Importing the modules registers their queries.
    from finspark.plans import (q_transforms, q_aggregates, q_quality,  # noqa: F401
                                q_sinks, q_sources, q_streams, q_jobs, q_cases, q_values)
    return QUERIES
