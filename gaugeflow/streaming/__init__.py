"""Structured Streaming forms of the scoring and maintenance operators."""
