"""Structured Streaming forms of loading and merging."""
