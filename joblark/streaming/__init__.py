"""The ingestion job as a Structured Streaming query."""
