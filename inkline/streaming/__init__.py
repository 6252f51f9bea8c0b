"""Structured Streaming forms of the article plan."""
