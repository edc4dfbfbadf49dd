"""Readers, writers, versioned tables and maintenance."""
