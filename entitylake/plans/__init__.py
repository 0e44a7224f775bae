"""Request lifecycles: windowed reads, incremental ingest, full sync."""
