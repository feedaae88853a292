"""Incremental landing as a Structured Streaming job."""
