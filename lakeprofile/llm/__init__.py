"""Operators for the preparation of large text corpora."""
