"""Relational building blocks: ordering, dedup, aggregation, increments, matching."""
