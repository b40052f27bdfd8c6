"""Structured Streaming drivers for the incremental load jobs."""
