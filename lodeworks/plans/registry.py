"""All registered queries of the core package and their SQL."""

from . import delivery, delivery_oracles, oracles, queries

QUERIES = {**queries.QUERIES, **delivery.QUERIES}
ORACLES = {**oracles.ORACLES, **delivery_oracles.ORACLES}

__all__ = ["ORACLES", "QUERIES"]
