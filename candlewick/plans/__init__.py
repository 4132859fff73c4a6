"""Registered queries (Spark) and their DuckDB oracle statements.

Import ``candlewick.plans.registry`` for QUERIES / ORACLES / entry_query.
"""
