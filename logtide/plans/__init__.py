"""Registered queries over the benchmark tables, with their DuckDB oracles."""

from logtide.plans import analytics, chain, decoding, delivering, ingest, observing  # noqa: F401  (fill the registry)
from logtide.plans.registry import QUERIES  # noqa: F401
