"""Registered queries: each a plan over the test tables, with independent SQL where SQL can say it."""

from tallyhouse.catalog.registry import ORACLES, QUERIES, run

__all__ = ["ORACLES", "QUERIES", "load_all", "run"]


def load_all() -> None:
    """Import the modules that register queries."""
    from tallyhouse.catalog import dashboards, files, history, loading, reports, star, streams  # noqa: F401
