"""Live ingestion with Structured Streaming."""
