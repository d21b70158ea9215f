"""Registered queries: whole plans from the given tables to a result."""
