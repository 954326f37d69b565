"""Structured Streaming form of the receiving side."""
