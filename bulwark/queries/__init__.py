"""Registered queries: operators bound to the given tables, each with its DuckDB check if there is one."""

from bulwark.queries import (  # noqa: F401
    aggregates,
    composites,
    flags,
    joins,
    learning,
    perturbation,
    projections,
    scans,
    selection,
    series,
    setops,
    streams,
    vectors,
)
from bulwark.queries.registry import REGISTRY  # noqa: F401
