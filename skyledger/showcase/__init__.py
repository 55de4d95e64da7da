"""The registered queries: each operator on the given tables, beside the same result in SQL."""

from . import (  # noqa: F401 - importing registers the queries
    checks, cleaning, extraction, history, jobs, marts, members, merging, roundtrips, streams, tables,
)
from .registry import QUERIES

__all__ = ["QUERIES"]
