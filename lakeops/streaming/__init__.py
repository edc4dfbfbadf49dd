"""Structured Streaming pipelines and change-data capture."""
