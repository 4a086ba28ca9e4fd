"""Structured Streaming: sinks, the four jobs, progress metrics."""
