"""All registered queries."""

from vanewatch.plans import batchjob, feeds, fits, live, risk, series, vectors, watch  # noqa: F401
from vanewatch.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
