"""Continuous synchronisation with Structured Streaming."""
