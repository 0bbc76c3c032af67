"""Structured Streaming twins of the monitoring and scoring jobs."""
