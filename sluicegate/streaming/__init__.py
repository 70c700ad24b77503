"""Structured Streaming pipelines over the same operators."""
