"""Queries on the driver's tables, registered on import."""

from snapflow.queries import cards, catalogue, members, prices, runs, streams, texts  # noqa: F401
from snapflow.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
