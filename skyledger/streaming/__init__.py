"""Incremental jobs over newly landed files."""

from .ingest import incremental_upsert, ingest_incremental, ingest_within

__all__ = ["incremental_upsert", "ingest_incremental", "ingest_within"]
