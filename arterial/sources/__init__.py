"""Batch and streaming sources and sinks."""
