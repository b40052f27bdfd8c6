"""Reusable DataFrame operators: joins, aggregates, windows, hierarchies,
table state and rule-based validation."""
