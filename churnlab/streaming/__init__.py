"""Structured Streaming hooks (the reference itself has no streams)."""
