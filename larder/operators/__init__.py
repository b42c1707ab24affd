"""Joins, aggregates, windows, quality rules and physical tuning."""
