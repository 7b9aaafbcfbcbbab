"""Structured Streaming forms of intake and of the silver build."""
