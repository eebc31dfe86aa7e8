"""Structured Streaming counters and runners."""
