"""Incremental landing of new files into bronze with Structured Streaming."""
