"""Structured Streaming forms of query preparation and gate monitoring."""
