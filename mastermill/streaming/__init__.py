"""Structured Streaming entry points."""

from .ingest import ingest_stream, stream_files, stream_rows

__all__ = ["ingest_stream", "stream_files", "stream_rows"]
