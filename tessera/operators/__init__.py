"""Reusable DataFrame operators (joins, aggregates, windows, reshape,
profiling, quality, cleaning, mutation, routing)."""
