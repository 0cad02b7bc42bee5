"""Column-level functions: scoring, text, privacy, vectors and JSON."""
