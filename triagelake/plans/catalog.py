"""All queries and their SQL counterparts."""

from triagelake.plans import catalog_incidents, catalog_rollup, catalog_runs, catalog_streams, catalog_tables, catalog_text
from triagelake.plans.registry import ORACLES, QUERIES

MODULES = (catalog_text, catalog_tables, catalog_rollup, catalog_incidents, catalog_runs, catalog_streams)

__all__ = ["MODULES", "ORACLES", "QUERIES"]
