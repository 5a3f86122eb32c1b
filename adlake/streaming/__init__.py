"""Structured Streaming forms of the incremental and windowed operators."""
