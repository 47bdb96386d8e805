"""Registered queries: Spark code and, beside it, the SQL that must give the same rows."""

from sparklake.queries import (  # noqa: F401  (importing registers the queries)
    gold,
    jobs,
    macro,
    payloads,
    quality,
    risk,
    selection,
    silver,
    storage,
)
from sparklake.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
