"""Structured Streaming twins of the resumable load and the audit log."""
