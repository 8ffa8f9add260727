"""Registered queries: key -> (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (through the adapters) and returns flat,
aliased columns so it can be compared with its DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def load_all() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    # importing the modules registers their queries
    from quadrant.plans import (q_catalog, q_evaluate, q_incremental, q_label,  # noqa: F401
                                q_quads, q_sources, q_transcripts)
    return dict(QUERIES)
