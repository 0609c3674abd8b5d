"""Structured Streaming scorers and stateful drift."""
