"""All registered queries of the engine and their SQL."""

from clipflow.plans import cells, clouds, fits, matching, motion, overlap, parking, queues, rings, shapes, signals, visibility, world  # noqa: F401  each module adds its queries
from clipflow.plans.catalog import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
