"""Structured Streaming form of the incremental payment load."""
