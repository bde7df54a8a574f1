"""Structured Streaming: ingestion, live measures and incremental refresh."""
