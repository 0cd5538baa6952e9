"""Incremental scoring of newly landed feature files with Structured Streaming."""
