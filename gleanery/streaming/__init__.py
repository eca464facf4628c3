"""Structured Streaming flows."""

from .dedupe import first_of_keys
from .ingest import atom_stream, ingest, ingest_unique

__all__ = ["atom_stream", "first_of_keys", "ingest", "ingest_unique"]
