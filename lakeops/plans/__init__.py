"""Models composed from operators."""
