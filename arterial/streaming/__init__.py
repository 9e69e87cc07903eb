"""Structured Streaming sources, sinks and queries."""
