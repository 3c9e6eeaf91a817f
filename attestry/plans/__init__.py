"""Registered queries, the table adapters they share, and their DuckDB counterparts."""
