"""Registered queries: each operator over the given tables, with its SQL check."""

from . import core
from . import aggregate_queries, gold_queries, increment_queries, io_queries, learning_queries  # noqa: F401
from . import match_queries, row_queries, silver_queries, stream_queries  # noqa: F401

QUERIES = core.QUERIES
ORACLES = core.ORACLES
