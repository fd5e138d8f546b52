"""Registered queries.  Importing this package fills the registry."""

from tastegrid.plans.registry import ORACLES, QUERIES, registered

__all__ = ["ORACLES", "QUERIES", "registered", "load"]


def load() -> None:
    """Import every module that registers queries."""
    from tastegrid.plans import (aggregates, analyses, bins, cleaning, encoding,  # noqa: F401
                                 evaluation, forest, hybrid, joining, ordering, recommend, sampling, similar,
                                 scalars, scans)
