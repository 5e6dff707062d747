"""Structured Streaming entry points: topic streams, stream sinks, incremental runs."""
