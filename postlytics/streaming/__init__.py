"""Structured Streaming forms of ingest and the daily report."""
