"""Operators for corpora of training documents, and their queries."""
