"""Registered queries on the driver tables, each beside its DuckDB oracle."""
