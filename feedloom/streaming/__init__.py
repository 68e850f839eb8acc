"""Structured Streaming forms of ingestion (ST1-ST4)."""
