"""Structured Streaming jobs."""

from emporia.streaming.incremental import incremental_ingest  # noqa: F401
