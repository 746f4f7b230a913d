"""Structured Streaming forms of publishing and archiving."""
