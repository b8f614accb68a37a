"""All registered queries."""

from tripwright.plans.queries import joined, messages, scores, stored, tracks
from tripwright.plans.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "joined", "messages", "scores", "stored", "tracks"]
