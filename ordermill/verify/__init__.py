"""Checks: dirty orders derived from the driver's tables, registered queries, SQL oracles."""
