"""Structured Streaming sources, event-time operators and sinks."""
