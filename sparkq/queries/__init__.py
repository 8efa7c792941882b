"""Registered queries: name -> callable, and name -> oracle SQL."""

from sparkq.queries.registry import ORACLES, QUERIES
from sparkq.queries import (  # noqa: E402,F401  (each module registers its queries)
    accounting,
    changes,
    encoding,
    paging,
    params,
    relational,
    shaping,
    streaming,
    text,
    writes,
)

__all__ = ["ORACLES", "QUERIES"]
