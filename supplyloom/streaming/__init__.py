"""Structured Streaming queries: landing -> bronze -> silver -> scored."""
