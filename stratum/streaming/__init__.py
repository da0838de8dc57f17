"""Structured Streaming ingest of JSON events into Bronze."""
