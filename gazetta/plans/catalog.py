"""All registered queries."""

from gazetta.plans import columns, composed, directory, jobs, links, rows, webpages, writes  # noqa: F401
from gazetta.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
