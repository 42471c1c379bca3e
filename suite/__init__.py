"""Queries over the shared test tables, each beside the SQL that checks it."""

from suite import arrivals, cleaning, dates, lookups, scans, star, tables  # noqa: F401
from suite.registry import ORACLES, QUERIES  # noqa: F401
