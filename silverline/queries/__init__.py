"""Every operator as a query over the given tables."""

from silverline.queries.registry import ORACLES, QUERIES, names_of
from silverline.queries import archives, cleaning, files, jobs, markup, scalars, streams, summaries, timed  # noqa: F401

__all__ = ["ORACLES", "QUERIES", "names_of"]
