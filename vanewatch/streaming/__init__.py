"""Structured Streaming operators."""
