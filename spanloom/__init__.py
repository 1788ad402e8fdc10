"""Span analytics on Spark."""
