"""Structured Streaming versions of scoring and monitoring."""
