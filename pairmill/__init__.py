"""Spark jobs that prepare, gate and score corpora of query/reply pairs."""

from pairmill.settings import Settings

__all__ = ["Settings"]
