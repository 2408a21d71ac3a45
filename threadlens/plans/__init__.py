"""Registered queries (one per product operator), their DuckDB oracles, and
physical-plan checks."""
