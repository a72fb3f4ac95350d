"""Registered queries; importing the modules below fills the registry."""

from touchgrid.catalog import facts, identities, loads, outcomes, raw_reports, reports, sql_face, texts  # noqa: F401
from touchgrid.catalog.registry import all_oracles, all_queries, coverage

__all__ = ["all_oracles", "all_queries", "coverage"]
