"""The registered queries over the given tables."""

from shelfwise.plans import (  # noqa: F401
    anomalies, cleaning, enrichment, feeds, profiling, recommending, storage_io, streams,
    validation)
from shelfwise.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
