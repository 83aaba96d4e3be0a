"""Structured Streaming: the batch operators on unbounded input, and the live reconciliation."""
