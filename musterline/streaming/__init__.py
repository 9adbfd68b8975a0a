"""Structured Streaming jobs over the trade operators."""
