"""Structured Streaming jobs: copies, several sinks, change streams."""
