"""Data products: silver and gold tables, quality and partition monitors, learning."""
