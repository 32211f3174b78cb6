"""Structured Streaming wiring of sources, stages and sinks."""
