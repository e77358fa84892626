"""Incremental (Structured Streaming) ingestion of chunked folders."""
