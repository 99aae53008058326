"""Structured Streaming: progressive shard reads, validation, metric streams."""
