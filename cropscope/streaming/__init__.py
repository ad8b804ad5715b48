"""Structured Streaming operators over file sources."""
