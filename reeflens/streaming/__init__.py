"""Incremental ingestion of new survey exports (Structured Streaming)."""
