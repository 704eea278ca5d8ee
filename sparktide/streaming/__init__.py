"""Structured Streaming captures, sinks and rates."""
