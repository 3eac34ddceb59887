"""Registered queries: key -> Spark builder, output columns and the SQL another engine runs."""

from tidemark.registry.core import REGISTRY, oracles, runners

from tidemark.registry import (  # noqa: E402,F401  (importing a module registers its queries)
    governance,
    ingest,
    knowledge,
    marts,
    merges,
    quality,
    reports,
    seeds,
)

__all__ = ["REGISTRY", "oracles", "runners"]
