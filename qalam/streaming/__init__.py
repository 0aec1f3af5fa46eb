"""Streaming use of the stateless cleaning (the reference itself has no streaming operator)."""
