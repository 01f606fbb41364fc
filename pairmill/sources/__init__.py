"""Readers, writers, pair builders and staged tables."""
