"""Structured Streaming views over the append-only logs."""
