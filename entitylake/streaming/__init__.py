"""Structured Streaming ingest of a landing folder of entity-batch files."""
