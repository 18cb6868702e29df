"""Structured Streaming form of silver -> gold."""
