"""All DuckDB oracle SQL, keyed like the registered queries."""

from __future__ import annotations


def all_oracles() -> dict[str, str]:
    from quadrant.plans import (oracle_catalog, oracle_evaluate, oracle_incremental,  # noqa: F401
                                oracle_quads, oracle_sources, oracle_transcripts)
    from quadrant.plans.oracle_base import ORACLE
    return dict(ORACLE)
